"""The query catalogue: one named Spark query per operator of the survey,
each paired (where SQL can express it) with a DuckDB oracle.

Queries take ``(spark, sf_dir)``, read the provided tables through
``sources.bindings`` and run the library's operators over the whole tables.
Doubles that come out of floating-point work are rounded for comparison by
``r4`` (same IEEE steps as the SQL ``r4``); columns are aliased to the same
names on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as P
from ..operators import clean as C
from ..operators import indicators as I
from ..operators import quotes as Q
from ..operators import report as R
from ..operators import views as V
from ..session import checkpoint_dir, materialize
from ..sources import bindings as B
from ..sources import feeds as FD
from ..sources import storage as S
from ..streaming import streams as ST
from . import sqlparts as SP
from .sqlparts import B1, B2, B3, B4, B6, B7, B8, CLEAN_LINES, CLEAN_QUOTES, cte, r4 as sr4, r6 as sr6, rnd, with_

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def utc(spark: SparkSession) -> None:
    """The engine's clock is UTC (the reference's local clock is not copied);
    time zones bind when a plan is analyzed, so this is set before building."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            utc(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r4(c) -> Column:
    """Comparison rounding to 4 places (twin of ``sqlparts.r4``, same IEEE
    steps; the 1e-6 nudge settles exact decimal ties identically)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c * F.lit(10000.0) + F.lit(0.500001)) / F.lit(10000.0))


#: Columns of small numbers, compared at 6 places.
SMALL = ("daily_return", "volatility")


def r6(c: str) -> Column:
    return F.floor(F.col(c) * F.lit(1000000.0) + F.lit(0.500001)) / F.lit(1000000.0)


def rounded(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """r4 (r6 on returns and volatility) on every double column; timestamps as TIMESTAMP_NTZ (UTC wall clock)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and f.name not in keep:
            out.append((r6 if f.name in SMALL else r4)(f.name).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sql_r4(cols, alias=True) -> str:
    near = lambda c: (sr6 if c in SMALL else sr4)(c)
    return ", ".join(f"{near(c)} AS {c}" if alias else near(c) for c in cols)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_GAPS = "SELECT * REPLACE (CASE WHEN year(date) <> 1994 THEN close END AS close) FROM b2"


@query("ewm_gaps", with_(cte("b2", B2), cte("g", _GAPS), SP.indicator_ctes("g", "ind"),
                         body=f"SELECT symbol, date, {sql_r4(['ema_12', 'macd', 'macd_signal'])}, {sr4('ema_12')} AS ema_12_small, {sr4('macd_signal')} AS macd_signal_small FROM ind"))
def q_ewm_gaps(spark, sf):
    """EWM columns of brand series whose prices miss for a year, longer than the halo;
    the smallest and the default block size give the same values."""
    b = B.bars_brand(spark, sf).withColumn("close", F.when(F.year("date") != 1994, F.col("close")))
    big = I.indicators(b, which=["ema_12", "macd", "macd_signal"]).select("symbol", "date", "ema_12", "macd", "macd_signal")
    small = I.indicators(b, which=["ema_12", "macd_signal"], block=1).select(
        "symbol", "date", F.col("ema_12").alias("ema_12_small"), F.col("macd_signal").alias("macd_signal_small"))
    return rounded(big.join(small, ["symbol", "date"]))


# ====================================================================== indicators

IND_SRC = [cte("b2", B2)]


def _ind(spark, sf, which, src=B.bars_brand, block=I.DEFAULT_BLOCK):
    df = src(spark, sf)
    return I.indicators(df, which=which, block=block)


def _ind_sql(cols):
    return with_(*IND_SRC, SP.indicator_ctes("b2", "ind"),
                 body=f"SELECT symbol, date, {sql_r4(cols)} FROM ind")


def _ind_query(name, cols, block=I.DEFAULT_BLOCK):
    def fn(spark, sf):
        return rounded(_ind(spark, sf, cols, block=block).select("symbol", "date", *cols))
    fn.__doc__ = f"{', '.join(cols)} per brand series (bars_brand)" + (
        "; the smallest blocks the EWM halo allows (halo + 1 rows), so long series cross block borders."
        if block != I.DEFAULT_BLOCK else ".")
    query(name, _ind_sql(cols))(fn)


_ind_query("ind_sma", ["sma_5", "sma_20"])
_ind_query("ind_ema", ["ema_12", "ema_26"], block=1)
_ind_query("ind_macd", ["macd", "macd_signal", "macd_histogram"], block=1)
_ind_query("ind_rsi", ["rsi"])
_ind_query("ind_bollinger", ["bb_middle", "bb_upper", "bb_lower"])
_ind_query("ind_return", ["daily_return"])
_ind_query("ind_volatility", ["volatility"])


@query("indicators_all", with_(*IND_SRC, SP.indicator_ctes("b2", "ind"),
                               body=f"SELECT symbol, date, {sql_r4(['close'] + SP.INDICATORS)} FROM ind"))
def q_indicators_all(spark, sf):
    """All 13 indicators over every brand series: one index, one blocked pass."""
    df = B.bars_brand(spark, sf)
    return rounded(I.indicators(df).select("symbol", "date", "close", *I.INDICATOR_COLUMNS))


ROLLING = ["sma_5", "sma_20", "rsi", "bb_middle", "bb_upper", "bb_lower", "daily_return", "volatility"]


@query("indicators_events", with_(cte("b1", B1), SP.indicator_ctes("b1", "ind"),
                                  body=f"SELECT symbol, date, {sql_r4(['close'] + ROLLING)} FROM ind"))
def q_indicators_events(spark, sf):
    """The trailing-frame indicators on the 5 event-type series with 21-row
    blocks (the smallest their 20-row halo allows): every 30-day series
    spans two blocks, so each value near a border comes from halo copies."""
    df = B.bars_events(spark, sf)
    return rounded(I.indicators(df, block=21, which=ROLLING).select("symbol", "date", "close", *ROLLING))


_HOT_ORDER = ["date", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]


@query("indicators_hot", with_(
    cte("hot", "SELECT 'ALL' AS symbol, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_extendedprice / l_quantity AS close FROM lineitem"),
    SP.indicator_ctes("hot", "ind", order=", ".join(_HOT_ORDER), reach=900),
    body=f"SELECT symbol, date, l_orderkey, l_linenumber, {sql_r4(['l_extendedprice', 'l_quantity', 'close'] + SP.INDICATORS)} FROM ind"))
def q_indicators_hot(spark, sf):
    """All 13 indicators over one series holding every line item (a single
    hot key): the blocked pass spreads it over all tasks. The oracle's EWM
    self-joins look back 900 rows, beyond which weights are below 1e-20."""
    df = B.line_prices(spark, sf)
    order = ["date", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]
    return rounded(I.indicators(df, order=order).select("symbol", *order, "close", *I.INDICATOR_COLUMNS))


W10 = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
W7 = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@query("roll_mean", with_(*IND_SRC, body=f"SELECT symbol, date, {sr4(f'CASE WHEN count(close) OVER {W10} = 10 THEN avg(close) OVER {W10} END')} AS close_mean_10 FROM b2"))
def q_roll_mean(spark, sf):
    """rolling(10).mean() of close per brand."""
    return rounded(I.rolling_mean(B.bars_brand(spark, sf), "close", 10).select("symbol", "date", "close_mean_10"))


@query("roll_std", with_(*IND_SRC, body=f"SELECT symbol, date, {sr4(f'CASE WHEN count(volume) OVER {W7} = 7 THEN stddev_samp(volume) OVER {W7} END')} AS volume_std_7 FROM b2"))
def q_roll_std(spark, sf):
    """rolling(7).std() of volume per brand."""
    return rounded(I.rolling_std(B.bars_brand(spark, sf), "volume", 7).select("symbol", "date", "volume_std_7"))


@query("diff1", with_(*IND_SRC, body=f"SELECT symbol, date, {sr4('close - lag(close) OVER (PARTITION BY symbol ORDER BY date)')} AS close_diff FROM b2"))
def q_diff1(spark, sf):
    """diff() of close per brand."""
    return rounded(I.diff(B.bars_brand(spark, sf), "close").select("symbol", "date", "close_diff"))


@query("ema_span", with_(*IND_SRC, cte("s", "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS i FROM b2"),
                         body=f"SELECT a.symbol, a.date, {sr4('sum(b.volume * pow(' + SP.ewm_d(5) + ', a.i - b.i)) / sum(pow(' + SP.ewm_d(5) + ', a.i - b.i))')} AS volume_ema_5 FROM s a JOIN s b ON a.symbol = b.symbol AND b.i <= a.i GROUP BY a.symbol, a.date"))
def q_ema_span(spark, sf):
    """ewm(span=5).mean() of volume per brand (a span whose block limit is
    below the default block size)."""
    return rounded(I.ewm_mean(B.bars_brand(spark, sf), "volume", 5, out="volume_ema_5")
                   .select("symbol", "date", "volume_ema_5"))


# ====================================================================== cleaning

B4_SRC = [cte("b1", B1), cte("b4", B4)]
BAR_COLS = ["symbol", "date", "open", "high", "low", "close", "volume", "batch_id"]


@query("dedup_rows", with_(*B4_SRC, body=f"SELECT DISTINCT {', '.join(BAR_COLS)} FROM b4"))
def q_dedup_rows(spark, sf):
    """Exact duplicate rows dropped (bars with repeated days)."""
    return C.dedup_rows(B.bars_gaps(spark, sf)).select(*BAR_COLS)


FF = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BF = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("fill_prices", with_(*B4_SRC, body=f"SELECT symbol, date, open, high, low, coalesce(close, last_value(close IGNORE NULLS) OVER {FF}, first_value(close IGNORE NULLS) OVER {BF}) AS close, volume, batch_id FROM b4"))
def q_fill_prices(spark, sf):
    """Forward then backward fill of prices per symbol by date."""
    return C.fill_prices(B.bars_gaps(spark, sf)).select(*BAR_COLS)


@query("fill_prices_blocked", with_(*B4_SRC, body=f"SELECT symbol, date, open, high, low, coalesce(close, last_value(close IGNORE NULLS) OVER {FF}, first_value(close IGNORE NULLS) OVER {BF}) AS close, volume, batch_id FROM b4"))
def q_fill_prices_blocked(spark, sf):
    """The same fill with 4-row blocks: carries cross many block borders."""
    return C.fill_prices(B.bars_gaps(spark, sf), block=4).select(*BAR_COLS)


@query("fill_median", with_(*B4_SRC, body="SELECT symbol, date, open, high, low, close, coalesce(volume, median(volume) OVER (PARTITION BY batch_id)) AS volume, batch_id FROM b4"))
def q_fill_median(spark, sf):
    """Nulls of volume filled with the exact batch median."""
    return C.fill_median(B.bars_gaps(spark, sf), cols=["volume"]).select(*BAR_COLS)


@query("dedup_lines", with_(cte("b7", B7), body=f"SELECT DISTINCT symbol, {sr4('current_price')} AS current_price, {sr4('previous_close')} AS previous_close, {sr4('change')} AS change, timestamp, batch_id FROM b7"))
def q_dedup_lines(spark, sf):
    """Exact duplicates among the line items' quotes."""
    return rounded(C.dedup_rows(B.quotes_lines(spark, sf))).distinct()


@query("fill_median_brand", with_(cte("b2", B2), cte("b8", B8), body="SELECT symbol, date, open, high, low, close, coalesce(volume, m) AS volume, batch_id FROM b8 JOIN (SELECT batch_id, median(volume) AS m FROM b8 GROUP BY 1) USING (batch_id)"))
def q_fill_median_brand(spark, sf):
    """Median fill of volume in yearly batches of all brands."""
    return C.fill_median(B.bars_brand_gaps(spark, sf), ["volume"])


@query("batch_median", with_(*[cte("b1", B1), cte("b3", B3)],
                             body=f"SELECT batch_id, {sr4('median(current_price)')} AS current_price, "
                                  f"{sr4('median(change_percent)')} AS change_percent FROM b3 GROUP BY batch_id"))
def q_batch_median(spark, sf):
    """Exact per-batch medians of two columns (distributed rank selection)."""
    return rounded(C.batch_medians(B.quotes_events(spark, sf), ["current_price", "change_percent"]))


NUM_B4 = ["open", "high", "low", "close", "volume"]
NULLS_B4 = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in NUM_B4)


@query("missing_cells", with_(*B4_SRC, body=f"SELECT batch_id, CAST(sum({NULLS_B4}) AS BIGINT) AS missing_cells, count(*) AS rows FROM b4 GROUP BY batch_id"))
def q_missing_cells(spark, sf):
    """Missing numeric cells per batch."""
    return C.missing_cells(B.bars_gaps(spark, sf))


CB_COLS = ["symbol", "date", "open", "high", "low", "close", "volume"] + SP.INDICATORS
@query("missing_cells_brand", with_(cte("b2", B2), cte("b8", B8), body=f"SELECT batch_id, CAST(sum({NULLS_B4}) AS BIGINT) AS missing_cells, count(*) AS rows FROM b8 GROUP BY batch_id"))
def q_missing_cells_brand(spark, sf):
    """Missing cells per yearly batch of all brands."""
    return C.missing_cells(B.bars_brand_gaps(spark, sf))


CB_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in CB_COLS)


@query("clean_bars", with_(*B4_SRC, *SP.clean_bars_ctes(),
                           body=f"SELECT symbol, date, batch_id, {sql_r4(['open', 'high', 'low', 'close', 'volume'] + SP.INDICATORS)} FROM cb"))
def q_clean_bars(spark, sf):
    """Bars batch job: dedup, price fill, median fill, gate, 13 indicators."""
    out = R.clean_bars(B.bars_gaps(spark, sf))
    return rounded(out.select("symbol", "date", "batch_id", "open", "high", "low", "close", "volume",
                              *I.INDICATOR_COLUMNS))


@query("clean_bars_brand", with_(cte("b2", B2), cte("b8", B8), *SP.clean_bars_ctes("b8"),
                                 body=f"SELECT symbol, date, batch_id, {sql_r4(['open', 'high', 'low', 'close', 'volume'] + SP.INDICATORS)} FROM cb"))
def q_clean_bars_brand(spark, sf):
    """The bars batch job over yearly batches of all brands, with gaps and repeated rows."""
    out = R.clean_bars(B.bars_brand_gaps(spark, sf))
    return rounded(out.select("symbol", "date", "batch_id", "open", "high", "low", "close", "volume",
                              *I.INDICATOR_COLUMNS))


@query("quality_score", with_(*B4_SRC, *SP.clean_bars_ctes(),
                              body=f"SELECT batch_id, count(*) AS final_rows, {rnd(f'100 * (1 - CAST(sum({CB_NULLS}) AS DOUBLE) / (count(*) * {len(CB_COLS)}))')} AS data_quality_score FROM cb GROUP BY batch_id"))
def q_quality_score(spark, sf):
    """Quality score of the processed bars, warm-up nulls included."""
    return C.quality_score(R.clean_bars(B.bars_gaps(spark, sf)))


@query("min_rows_gate", with_(*IND_SRC, body="SELECT symbol, date_trunc('month', date)::DATE AS month, date, count(*) OVER (PARTITION BY symbol, date_trunc('month', date)) > 20 AS indicators_ok FROM b2"))
def q_min_rows_gate(spark, sf):
    """Row gate (> 20 rows) per brand-month series."""
    df = B.bars_brand(spark, sf).withColumn("month", F.trunc("date", "month"))
    return C.min_rows_gate(df, ["symbol", "month"]).select("symbol", "month", "date", "indicators_ok")


QUOTE_SRC = [cte("b1", B1), cte("b3", B3)]
QUOTE_COLS = ["symbol", "current_price", "high_price", "low_price", "open_price", "previous_close",
              "change", "change_percent", "timestamp", "batch_id"]
CQ_COLS = QUOTE_COLS + ["change_percent_calc", "sentiment"]
CQ_DBL = ["current_price", "high_price", "low_price", "open_price", "previous_close", "change",
          "change_percent", "change_percent_calc"]


def _cq_select(prefix=""):
    return (f"{prefix}symbol, {sql_r4(CQ_DBL)}, {prefix}timestamp, {prefix}batch_id, {prefix}sentiment")


@query("clean_quotes", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT {_cq_select()} FROM cq"))
def q_clean_quotes(spark, sf):
    """Quotes batch job: dedup, price fill, median fill, change %, sentiment."""
    return rounded(R.clean_quotes(B.quotes_events(spark, sf)).select(*CQ_COLS))


CL_DBL = ["current_price", "previous_close", "change", "change_percent_calc"]
CL_BODY = f"SELECT symbol, {sql_r4(CL_DBL)}, timestamp, batch_id, sentiment FROM cl"


@query("clean_quotes_lines", with_(cte("b7", B7), CLEAN_LINES, body=CL_BODY))
def q_clean_quotes_lines(spark, sf):
    """The quotes batch job over a quote per line item: missing prices and cells, repeated
    rows and a symbol with a third of all rows."""
    return rounded(R.clean_quotes(B.quotes_lines(spark, sf)).select("symbol", *CL_DBL, "timestamp", "batch_id", "sentiment"))


@query("stream_clean_lines", with_(cte("b7", B7), CLEAN_LINES, body=CL_BODY))
def q_stream_clean_lines(spark, sf):
    """The same by three runs of the file stream, whose files split every batch."""
    q, root = B.quotes_lines(spark, sf), scratch(spark, "stream-lines")
    part = F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(3))
    for k in range(3):
        q.where(part == k).write.mode("append").partitionBy("batch_id").parquet(f"{root}/src")
        ST.stream_clean(spark, f"{root}/src", f"{root}/dst", f"{root}/ck", q.schema, R.clean_quotes).awaitTermination()
    out = S.read_table(spark, f"{root}/dst").withColumn("batch_id", F.col("batch_id").cast("string"))
    return rounded(out.select("symbol", *CL_DBL, "timestamp", "batch_id", "sentiment"))


# cleaning report (C06) over 30 quote batches and one bars batch, flattened one row per step
NUM_Q = ["current_price", "high_price", "low_price", "open_price", "previous_close", "change", "change_percent"]
OUT_Q = ["symbol"] + NUM_Q + ["timestamp", "change_percent_calc", "sentiment"]


def _nulls(cols):
    return " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)


def report_ctes(pre, quotes, cleaned, num_q, out_q, bars):
    """CTEs of the cleaning report: ``rep`` (a row per file) and ``steps``."""
    return [
        *pre,
        cte("rep_q", f"""SELECT o.batch_id, 'quotes' AS file_type, o.n AS original_rows, f.n AS final_rows,
        {rnd(f"100 * (1 - CAST(f.nulls AS DOUBLE) / (f.n * {len(out_q)}))")} AS data_quality_score,
        o.n - d.n AS removed, d.miss AS missing_before, f.miss AS missing_after
      FROM (SELECT batch_id, count(*) AS n FROM {quotes} GROUP BY 1) o
      JOIN (SELECT batch_id, count(*) AS n, sum({_nulls(num_q)}) AS miss FROM (SELECT DISTINCT * FROM {quotes}) GROUP BY 1) d USING (batch_id)
      JOIN (SELECT batch_id, count(*) AS n, sum({_nulls(num_q)}) AS miss, sum({_nulls(out_q)}) AS nulls FROM {cleaned} GROUP BY 1) f USING (batch_id)"""),
        cte("rep_b", f"""SELECT o.batch_id, 'historical' AS file_type, o.n AS original_rows, f.n AS final_rows,
        {rnd(f"100 * (1 - CAST(f.nulls AS DOUBLE) / (f.n * {len(CB_COLS)}))")} AS data_quality_score,
        o.n - d.n AS removed, d.miss AS missing_before, f.miss AS missing_after
      FROM (SELECT batch_id, count(*) AS n FROM {bars} GROUP BY 1) o
      JOIN (SELECT batch_id, count(*) AS n, sum({NULLS_B4}) AS miss FROM (SELECT DISTINCT * FROM {bars}) GROUP BY 1) d USING (batch_id)
      JOIN (SELECT batch_id, count(*) AS n, sum({NULLS_B4}) AS miss, sum({CB_NULLS}) AS nulls FROM cb GROUP BY 1) f USING (batch_id)"""),
        cte("rep", "SELECT * FROM rep_q UNION ALL SELECT * FROM rep_b"),
        cte("steps", f"""
      SELECT batch_id, file_type, 1 AS k, 'remove_duplicates' AS step, removed AS rows_removed, NULL::BIGINT AS missing_before, NULL::BIGINT AS missing_after, NULL AS added FROM rep WHERE removed <> 0
      UNION ALL SELECT batch_id, file_type, 2, 'handle_missing_values', NULL, missing_before, missing_after, NULL FROM rep WHERE missing_before > 0
      UNION ALL SELECT batch_id, file_type, 3, 'technical_indicators', NULL, NULL, NULL, '{",".join(R.INDICATORS_ADDED)}' FROM rep WHERE file_type = 'historical'
      UNION ALL SELECT batch_id, file_type, 4, 'market_analysis', NULL, NULL, NULL, '{",".join(R.ANALYSIS_ADDED)}' FROM rep WHERE file_type = 'quotes'"""),
    ]


REPORT_CTES = report_ctes([cte("b1", B1), cte("b3", B3), cte("b4", B4), CLEAN_QUOTES, *SP.clean_bars_ctes()],
                          "b3", "cq", NUM_Q, OUT_Q, "b4")
NUM_L = ["current_price", "previous_close", "change"]
LINE_CTES = report_ctes([cte("b2", B2), cte("b7", B7), cte("b8", B8), CLEAN_LINES, *SP.clean_bars_ctes("b8")],
                        "b7", "cl", NUM_L, ["symbol", *NUM_L, "timestamp", "change_percent_calc", "sentiment"], "b8")


def _report(spark, sf):
    """Clean both kinds of raw batches (read as stored tables), write the
    processed tables (as the cleaning job does), report from the written
    tables and write the report (one row per batch) for its readers."""
    q_raw = materialize(B.quotes_events(spark, sf), "raw-quotes")
    b_raw = materialize(B.bars_gaps(spark, sf), "raw-bars")
    rq = R.cleaning_report(q_raw, materialize(R.clean_quotes(q_raw), "processed-quotes"), "quotes")
    rb = R.cleaning_report(b_raw, materialize(R.clean_bars(b_raw), "processed-bars"), "historical")
    return materialize(rq.unionByName(rb), "report")


_REPORT_BODY = """SELECT r.batch_id, r.file_type, r.original_rows, r.final_rows, r.data_quality_score,
    s.step, CAST(s.rows_removed AS BIGINT) AS rows_removed, CAST(s.missing_before AS BIGINT) AS missing_before,
    CAST(s.missing_after AS BIGINT) AS missing_after, s.added
  FROM rep r LEFT JOIN steps s USING (batch_id, file_type)"""


def _report_rows(rep):
    return rep.select("batch_id", "file_type", "original_rows", "final_rows", "data_quality_score",
                      F.explode_outer("steps").alias("s")).select(
        "batch_id", "file_type", "original_rows", "final_rows", "data_quality_score",
        F.col("s.step").alias("step"), F.col("s.rows_removed").alias("rows_removed"),
        F.col("s.missing_before").alias("missing_before"), F.col("s.missing_after").alias("missing_after"),
        F.array_join("s.added", ",").alias("added"))


@query("cleaning_report", with_(*REPORT_CTES, body=_REPORT_BODY))
def q_cleaning_report(spark, sf):
    """Per batch report, one row per step that acted (30 quote batches + 1 bars batch)."""
    return _report_rows(_report(spark, sf))


@query("cleaning_report_lines", with_(*LINE_CTES, body=_REPORT_BODY))
def q_cleaning_report_lines(spark, sf):
    """The report of monthly quote batches (a quote per line item) and yearly bar batches
    of all brands, with gaps and repeated rows in both."""
    q_raw = materialize(B.quotes_lines(spark, sf), "raw-quotes")
    b_raw = materialize(B.bars_brand_gaps(spark, sf), "raw-bars")
    rq = R.cleaning_report(q_raw, materialize(R.clean_quotes(q_raw), "processed-quotes"), "quotes")
    rb = R.cleaning_report(b_raw, materialize(R.clean_bars(b_raw), "processed-bars"), "historical")
    return _report_rows(rq.unionByName(rb))


@query("run_summary", with_(*REPORT_CTES, body=f"SELECT count(*) AS total_files_processed, {rnd('avg(data_quality_score)')} AS average_quality_score, count(*) AS file_entries FROM rep"))
def q_run_summary(spark, sf):
    """Run totals over the cleaning report, with the number of its file entries."""
    rep = _report(spark, sf)
    n = R.file_entries(rep, "run").groupBy("run_id").agg(F.count(F.lit(1)).alias("file_entries"))
    return R.run_summary(rep, "run").join(n, "run_id").select("total_files_processed", "average_quality_score", "file_entries")


@query("latest_summary", with_(*REPORT_CTES, body=f"SELECT CASE WHEN file_type = 'quotes' THEN 'stock_quotes_' ELSE 'stock_historical_' END || batch_id || '.csv' AS input_file, file_type, original_rows, count(*) OVER () AS total_files_processed, {rnd('avg(data_quality_score) OVER ()')} AS average_quality_score FROM rep"))
def q_latest_summary(spark, sf):
    """File entries and totals of the newest of two runs (V16); the older one holds quotes only."""
    rep = _report(spark, sf)
    old = rep.where("file_type = 'quotes'")
    sums = R.run_summary(old, "a", "2024-01-01 00:00:00").unionByName(R.run_summary(rep, "b", "2024-01-02 00:00:00"))
    files = R.file_entries(old, "a").unionByName(R.file_entries(rep, "b"))
    return R.latest_summary(sums, files).select("input_file", "file_type", F.col("stats.original_rows").alias("original_rows"),
                                                "total_files_processed", "average_quality_score")


def _file_name(kind_col="file_type", batch_col="batch_id"):
    return (f"CASE WHEN {kind_col} = 'quotes' THEN 'stock_quotes_' ELSE 'stock_historical_' END || {batch_col} || '.csv'")


@query("summary_steps", with_(*REPORT_CTES, body=f"""
  SELECT {_file_name()} AS input_file, 'file' AS step, 'original_rows' AS key, CAST(original_rows AS VARCHAR) AS value FROM rep
  UNION ALL SELECT {_file_name()}, 'file', 'final_rows', CAST(final_rows AS VARCHAR) FROM rep
  UNION ALL SELECT {_file_name()}, 'file', 'data_quality_score', CAST(data_quality_score AS VARCHAR) FROM rep
  UNION ALL SELECT * FROM (
    SELECT {_file_name('r.file_type', 'r.batch_id')} AS input_file, s.step, kv.key, kv.value
    FROM rep r JOIN steps s USING (batch_id, file_type),
    (SELECT unnest([{{'key': 'rows_removed', 'value': CAST(s.rows_removed AS VARCHAR)}},
                    {{'key': 'missing_before', 'value': CAST(s.missing_before AS VARCHAR)}},
                    {{'key': 'missing_after', 'value': CAST(s.missing_after AS VARCHAR)}},
                    {{'key': CASE s.step WHEN 'technical_indicators' THEN 'indicators_added' WHEN 'market_analysis' THEN 'analysis_added' ELSE 'added' END, 'value': s.added}}], recursive := true)) kv
  ) WHERE value IS NOT NULL"""))
def q_summary_steps(spark, sf):
    """Summary drill-down in long form (file metrics and step key/values)."""
    return V.summary_steps(R.file_entries(_report(spark, sf), "run"))


@query("clean_status", with_(*REPORT_CTES, body=f"""SELECT 'data_clean' AS service, field, value FROM (
  SELECT 'status' AS field, CASE WHEN count(*) > 0 THEN 'completed' ELSE 'idle' END AS value FROM rep
  UNION ALL SELECT 'files_processed', CAST(count(*) AS VARCHAR) FROM rep
  UNION ALL SELECT 'average_quality_score', CAST({rnd('avg(data_quality_score)')} AS VARCHAR) FROM rep
  UNION ALL SELECT 'message', 'Successfully processed ' || count(*) || ' files' FROM rep
  UNION ALL SELECT 'timestamp', '2024-01-31T12:00:00.000000'
  UNION ALL SELECT 'processed_files', CAST(to_json(list(f ORDER BY f)) AS VARCHAR) FROM (SELECT
    CASE WHEN file_type = 'quotes' THEN 'stock_quotes_' ELSE 'stock_historical_' END || batch_id || '.csv' AS f FROM rep))"""))
def q_clean_status(spark, sf):
    """Status updates of the cleaning run (C09 outcome, T03 input) with its file list."""
    rep = _report(spark, sf)
    st = ST.clean_status(R.run_summary(rep, "run", "2024-01-31 12:00:00"), R.file_entries(rep, "run"))
    return st.select("service", "field", "value")


@query("clean_events", with_(*REPORT_CTES, body=f"SELECT 'data_processed' AS event, count(*) AS files_processed, {rnd('avg(data_quality_score)')} AS average_quality_score FROM rep"))
def q_clean_events(spark, sf):
    """Result event of the cleaning run."""
    e = ST.emit_events(R.run_summary(_report(spark, sf), "run"))
    return e.select("event", "files_processed", "average_quality_score")


# ====================================================================== quotes (Q01-Q02)

@query("quote_change", with_(*QUOTE_SRC, body=f"SELECT symbol, batch_id, {sr4('(current_price - previous_close) / nullif(previous_close, 0) * 100')} AS change_percent_calc FROM b3"))
def q_quote_change(spark, sf):
    return rounded(Q.quote_change(B.quotes_events(spark, sf)).select("symbol", "batch_id", "change_percent_calc"))


@query("quote_sentiment", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT symbol, batch_id, {sr4('change_percent_calc')} AS change_percent_calc, sentiment FROM cq"))
def q_quote_sentiment(spark, sf):
    return rounded(Q.quote_sentiment(B.quotes_events(spark, sf))
                   .select("symbol", "batch_id", "change_percent_calc", "sentiment"))


# ====================================================================== dashboard

LATEST_PROC = "(SELECT * FROM cq WHERE batch_id = (SELECT max(batch_id) FROM cq))"


def _stored_quotes(spark, sf):
    """B3 quotes as a written table (the dashboard reads stored batches)."""
    return materialize(B.quotes_events(spark, sf), "quotes")


def _preferred(spark, sf):
    raw = _stored_quotes(spark, sf)
    return V.prefer_processed(materialize(R.clean_quotes(raw), "processed-quotes"), raw)


@query("prefer_processed", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT {_cq_select()} FROM {LATEST_PROC}"))
def q_prefer_processed(spark, sf):
    """Latest processed quotes batch (processed exist, so raw is not used)."""
    return rounded(_preferred(spark, sf).select(*CQ_COLS))


SENT_COLORS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.SENTIMENT_COLORS.items())


@query("sentiment_counts", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT sentiment, count(*) AS count, CASE sentiment {SENT_COLORS} ELSE 'gray' END AS color FROM cq WHERE sentiment IS NOT NULL GROUP BY sentiment"))
def q_sentiment_counts(spark, sf):
    return V.sentiment_counts(R.clean_quotes(B.quotes_events(spark, sf)))


@query("change_bars", with_(*QUOTE_SRC, body=f"SELECT symbol, {sr4('change_percent')} AS change_percent, CASE WHEN change_percent > 0 THEN 'green' ELSE 'red' END AS color FROM b3"))
def q_change_bars(spark, sf):
    return rounded(V.change_bars(B.quotes_events(spark, sf)))


@query("volume_bars", with_(*QUOTE_SRC, body="SELECT q.symbol, v.volume FROM (SELECT symbol FROM b3 WHERE batch_id = (SELECT max(batch_id) FROM b3)) q LEFT JOIN (SELECT symbol, arg_max_null(volume, date) AS volume FROM b1 GROUP BY symbol) v USING (symbol)"))
def q_volume_bars(spark, sf):
    """Volume bars for the latest quotes, volume from each symbol's latest bar."""
    return V.volume_bars(V.latest_batch(_stored_quotes(spark, sf)), B.bars_events(spark, sf))


@query("metrics_table", with_(*QUOTE_SRC, body=f"SELECT symbol, {rnd('current_price')} AS current_price, {rnd('change_percent')} AS change_percent FROM b3 WHERE batch_id = (SELECT max(batch_id) FROM b3)"))
def q_metrics_table(spark, sf):
    return V.metrics_table(V.latest_batch(_stored_quotes(spark, sf)))


@query("market_kpis", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT {sr4('avg(current_price)')} AS avg_price, {sr4('avg(change_percent)')} AS market_trend, sum(volume) AS total_volume, count(*) AS active_stocks FROM {LATEST_PROC} LEFT JOIN (SELECT symbol, arg_max_null(volume, date) AS volume FROM b1 GROUP BY symbol) v USING (symbol)"))
def q_market_kpis(spark, sf):
    """Key figures of the newest batch; the volume is that of each symbol's latest bar."""
    return rounded(V.market_kpis(_preferred(spark, sf), B.bars_events(spark, sf)))


_NEW_LINES = "(SELECT * FROM cl WHERE batch_id = (SELECT max(batch_id) FROM cl))"


def _clean_lines(spark, sf):
    """Processed quotes of the line items, stored as the cleaning job stores them."""
    path = scratch(spark, "processed-lines")
    S.write_table(R.clean_quotes(B.quotes_lines(spark, sf)), path)
    return S.read_table(spark, path).withColumn("batch_id", F.col("batch_id").cast("string"))


@query("sentiment_counts_lines", with_(cte("b7", B7), CLEAN_LINES, body=f"SELECT sentiment, count(*) AS count, CASE sentiment {SENT_COLORS} ELSE 'gray' END AS color FROM cl WHERE sentiment IS NOT NULL GROUP BY sentiment"))
def q_sentiment_counts_lines(spark, sf):
    """Sentiment counts over the processed quotes of all line items."""
    return V.sentiment_counts(_clean_lines(spark, sf))


@query("market_kpis_lines", with_(cte("b7", B7), CLEAN_LINES, body=f"SELECT {sr4('avg(current_price)')} AS avg_price, {sr4('avg(change)')} AS market_trend, NULL::DOUBLE AS total_volume, count(*) AS active_stocks FROM {_NEW_LINES}"))
def q_market_kpis_lines(spark, sf):
    """Key figures of the newest monthly batch of the line items' quotes."""
    return rounded(V.market_kpis(V.latest_batch(_clean_lines(spark, sf)).withColumn("change_percent", F.col("change"))))


@query("recent_quotes_lines", with_(cte("b7", B7), CLEAN_LINES, body=f"SELECT symbol, {rnd('current_price')} AS current_price, sentiment FROM {_NEW_LINES}"))
def q_recent_quotes_lines(spark, sf):
    """The recent-data table of the newest monthly batch of the line items' quotes."""
    return V.recent_quotes(V.latest_batch(_clean_lines(spark, sf)))


@query("recent_quotes", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT symbol, {rnd('current_price')} AS current_price, {rnd('change_percent')} AS change_percent, sentiment FROM {LATEST_PROC}"))
def q_recent_quotes(spark, sf):
    return V.recent_quotes(_preferred(spark, sf))


BRAND_BATCHED = [cte("b2", B2), cte("bb", "SELECT *, strftime(date_trunc('month', date), '%Y%m%d') || '_000000' AS batch_id FROM b2")]


def _brand_batched(spark, sf):
    b = B.bars_brand(spark, sf)
    return b.withColumn("batch_id", B.batch_id_of(F.trunc("date", "month")))


@query("available_symbols", with_(*BRAND_BATCHED, body="SELECT DISTINCT symbol FROM bb"))
def q_available_symbols(spark, sf):
    return V.available_symbols(_brand_batched(spark, sf))


@query("latest_series", with_(*BRAND_BATCHED, body=f"SELECT symbol, date, {sr4('close')} AS close, batch_id FROM bb WHERE (symbol, batch_id) IN (SELECT (symbol, max(batch_id)) FROM bb GROUP BY symbol)"))
def q_latest_series(spark, sf):
    """Each brand's rows from the newest monthly batch that contains it."""
    return rounded(V.latest_series(_brand_batched(spark, sf)).select("symbol", "date", "close", "batch_id"))


@query("symbol_kpis", with_(*IND_SRC, SP.indicator_ctes("b2", "ind"),
                            body=f"SELECT symbol, {sr4('arg_max_null(close, date)')} AS current_price, {sr4('avg(volume)')} AS avg_volume, {sr6('arg_max_null(volatility, date)')} AS volatility, {sr4('arg_max_null(rsi, date)')} AS rsi FROM ind GROUP BY symbol"))
def q_symbol_kpis(spark, sf):
    return rounded(V.symbol_kpis(I.indicators(B.bars_brand(spark, sf), which=["volatility", "rsi"])))


_TECH = " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS indicator, '{c.replace('_', ' ').title()}' AS label, {sr4(f'arg_max_null({c}, date)')} AS value, count({c}) AS n FROM ind GROUP BY symbol"
    for c in V.TECHNICAL_COLUMNS)


@query("indicator_latest", with_(*IND_SRC, SP.indicator_ctes("b2", "ind"),
                                 body=f"SELECT symbol, indicator, label, value FROM ({_TECH}) WHERE n > 0"))
def q_indicator_latest(spark, sf):
    return rounded(V.indicator_latest(I.indicators(B.bars_brand(spark, sf), which=list(V.TECHNICAL_COLUMNS))))


STATUS_SRC = [cte("b6", B6), cte("sl", "SELECT service, field, arg_max(value, (ts, seq)) AS value, max(ts) AS ts FROM b6 GROUP BY 1, 2")]


@query("status_latest", with_(*STATUS_SRC, body="SELECT service, field, value, ts FROM sl"))
def q_status_latest(spark, sf):
    """Last write per (service, field) by (ts, seq)."""
    return rounded(ST.status_latest(B.status_log(spark, sf)))


@query("status_board", with_(*STATUS_SRC, body="""SELECT service, upper(left(service, 1)) || lower(substr(service, 2)) AS label,
    coalesce(max(CASE WHEN field = 'status' THEN value END), 'Unknown') AS status,
    max(CASE WHEN field = 'message' THEN value END) AS message,
    CASE max(CASE WHEN field = 'status' THEN value END) WHEN 'completed' THEN 'green' WHEN 'processing' THEN 'yellow' ELSE 'red' END AS color
  FROM sl GROUP BY service"""))
def q_status_board(spark, sf):
    return V.status_board(ST.status_latest(B.status_log(spark, sf)))


_CHART = " UNION ALL ".join(
    f"SELECT symbol, CAST(date AS TIMESTAMP) AS x, '{c}' AS series, {sr4(c)} AS value FROM ind WHERE {c} IS NOT NULL"
    for c in V.CHART_SERIES)


@query("chart_series", with_(cte("b1", B1), SP.indicator_ctes("b1", "ind"), body=_CHART))
def q_chart_series(spark, sf):
    """Long-form chart rows of the event-type series with indicators."""
    return rounded(V.chart_series(I.indicators(
        B.bars_events(spark, sf), which=[c for c in V.CHART_SERIES if c in I.INDICATOR_COLUMNS])))


@query("rsi_flags", with_(*IND_SRC, SP.indicator_ctes("b2", "ind"),
                          body=f"SELECT symbol, date, {sr4('rsi')} AS rsi, CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold' WHEN rsi IS NOT NULL THEN 'neutral' END AS rsi_flag FROM ind"))
def q_rsi_flags(spark, sf):
    df = V.rsi_flags(I.indicators(B.bars_brand(spark, sf), which=["rsi"]))
    return rounded(df.select("symbol", "date", "rsi", "rsi_flag"))


@query("round_display", with_(*IND_SRC, body="SELECT symbol, date, " + ", ".join(f"{rnd(c)} AS {c}" for c in ["open", "high", "low", "close", "volume"]) + " FROM b2"))
def q_round_display(spark, sf):
    return P.round_numeric(B.bars_brand(spark, sf), 2)


@query("format_metrics", with_(*QUOTE_SRC, body="SELECT symbol, batch_id, printf('$%.2f', current_price) AS current_price_fmt, printf('%.2f%%', change_percent) AS change_percent_fmt FROM b3"))
def q_format_metrics(spark, sf):
    df = P.format_metrics(B.quotes_events(spark, sf), {"current_price": "money", "change_percent": "percent"})
    return df.select("symbol", "batch_id", "current_price_fmt", "change_percent_fmt")


@query("epoch_dates", "SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch, make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS ts_back, CAST(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS DATE) AS date FROM events")
def q_epoch_dates(spark, sf):
    """Epoch seconds -> timestamp and date."""
    ev = B.read(spark, sf, "events").select("event_id", F.unix_timestamp("ts").alias("epoch"))
    return rounded(ev.select("event_id", "epoch", P.epoch_to_ts(F.col("epoch")).alias("ts_back"),
                             P.epoch_to_date(F.col("epoch")).alias("date")))


@query("project_available", with_(*QUOTE_SRC, body=f"SELECT symbol, {sql_r4(['current_price', 'change_percent'])} FROM b3"))
def q_project_available(spark, sf):
    """Wanted: symbol, current_price, change_percent, volume, sentiment; raw quotes have three."""
    return rounded(P.project_available(B.quotes_events(spark, sf),
                                       ["symbol", "current_price", "change_percent", "volume", "sentiment"]))


@query("filter_symbol", with_(*IND_SRC, body=f"SELECT symbol, date, {sr4('close')} AS close FROM b2 WHERE symbol = 'Brand#13'"))
def q_filter_symbol(spark, sf):
    return rounded(P.for_symbol(B.bars_brand(spark, sf), "Brand#13").select("symbol", "date", "close"))


@query("latest_batch", with_(*QUOTE_SRC, body=f"SELECT symbol, {sr4('current_price')} AS current_price, batch_id FROM b3 WHERE batch_id = (SELECT max(batch_id) FROM b3)"))
def q_latest_batch(spark, sf):
    return rounded(V.latest_batch(_stored_quotes(spark, sf)).select("symbol", "current_price", "batch_id"))


@query("with_ordinal", with_(*IND_SRC, body="SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS ordinal FROM b2"))
def q_with_ordinal(spark, sf):
    """1-based position per brand series (P16) via the distributed series index."""
    return V.with_ordinal(B.bars_brand(spark, sf)).select("symbol", "date", "ordinal")


# ====================================================================== feeds

BATCH_LIT = f"'{SP.FETCH_BATCH}'"
FETCH_TS = "TIMESTAMP '2024-01-31 00:00:00'"


def _feed_query(name, feed, sql, cols=None, dbl=()):
    def fn(spark, sf):
        out = FD.NORMALIZERS[feed](B.LANDING_BUILDERS[feed](spark, sf))
        out = out.select(*(cols or out.columns))
        return rounded(out, keep=tuple(c for c in out.columns if c not in dbl))
    fn.__doc__ = f"Normalizer of the {feed} feed over landed payloads built from the tables."
    query(name, sql)(fn)


_feed_query("feed_quote", "quote", with_(*QUOTE_SRC, body=f"SELECT symbol, {sql_r4(NUM_Q)}, timestamp, batch_id FROM b3"),
            dbl=NUM_Q)
_feed_query("feed_candle", "candle", with_(cte("b1", B1), body=f"SELECT symbol, date, open, high, low, close, volume, {BATCH_LIT} AS batch_id FROM b1"))
_feed_query("feed_profile", "profile", f"""SELECT s_name AS symbol, s_name AS name, n_name AS country, NULL::VARCHAR AS currency,
  NULL::VARCHAR AS exchange, NULL::VARCHAR AS industry, NULL::VARCHAR AS ipo, s_acctbal AS market_cap,
  NULL::DOUBLE AS shares_outstanding, NULL::VARCHAR AS logo, NULL::VARCHAR AS weburl, NULL::VARCHAR AS phone,
  {FETCH_TS} AS timestamp, {BATCH_LIT} AS batch_id FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
_feed_query("feed_company_news", "company_news", f"""SELECT lang AS symbol, text AS headline, NULL::VARCHAR AS summary, NULL::VARCHAR AS url,
  CASE WHEN doc_id <> 0 THEN make_timestamp(doc_id * 1000000) END AS datetime, source, lang AS category,
  NULL::VARCHAR AS image, NULL::VARCHAR AS sentiment, {BATCH_LIT} AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, floor(doc_id / 16) ORDER BY doc_id) AS rn FROM documents)""")
_feed_query("feed_market_news", "market_news", f"""SELECT text AS headline, NULL::VARCHAR AS summary, NULL::VARCHAR AS url,
  CASE WHEN doc_id <> 0 THEN make_timestamp(doc_id * 1000000) END AS datetime, source, lang AS category,
  NULL::VARCHAR AS image, lang AS related, {BATCH_LIT} AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY floor(doc_id / 32) ORDER BY doc_id) AS rn FROM documents)""")
QUARTERS = """SELECT o_orderstatus, year(o_orderdate) AS y, quarter(o_orderdate) AS q, avg(o_totalprice) AS avg_p,
  min(o_totalprice) AS min_p, max(o_totalprice) AS max_p, min(CAST(o_orderdate AS DATE)) AS first_d,
  max(CAST(o_orderdate AS DATE)) AS last_d FROM orders GROUP BY 1, 2, 3"""
_feed_query("feed_earnings", "earnings", with_(cte("qt", QUARTERS), body=f"""SELECT o_orderstatus AS symbol, {sr4('avg_p')} AS actual, min_p AS estimate,
  make_date(y, q * 3 - 2, 1) AS period, CAST(q AS INTEGER) AS quarter, CAST(y AS INTEGER) AS year, {FETCH_TS} AS timestamp, {BATCH_LIT} AS batch_id FROM qt"""),
            dbl=["actual"])
_feed_query("feed_dividend", "dividend", with_(cte("qt", QUARTERS), body=f"""SELECT o_orderstatus AS symbol, {sr4('avg_p')} AS amount, max_p AS adjusted_amount,
  make_date(y, q * 3 - 2, 1) AS declaration_date, first_d AS ex_dividend_date, last_d AS payment_date,
  NULL::DATE AS record_date, NULL::VARCHAR AS frequency, {BATCH_LIT} AS batch_id FROM qt"""), dbl=["amount"])
_feed_query("feed_recommendation", "recommendation", f"""SELECT o_orderstatus AS symbol, buy, hold, sell, strong_buy, strong_sell, m AS period, {BATCH_LIT} AS batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY m DESC) AS rn FROM (
    SELECT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
      CAST(sum(CAST(left(o_orderpriority, 1) = '2' AS INTEGER)) AS INTEGER) AS buy,
      CAST(sum(CAST(left(o_orderpriority, 1) = '3' AS INTEGER)) AS INTEGER) AS hold,
      CAST(sum(CAST(left(o_orderpriority, 1) = '4' AS INTEGER)) AS INTEGER) AS sell,
      CAST(sum(CAST(left(o_orderpriority, 1) = '1' AS INTEGER)) AS INTEGER) AS strong_buy,
      CAST(sum(CAST(left(o_orderpriority, 1) = '5' AS INTEGER)) AS INTEGER) AS strong_sell
    FROM orders GROUP BY 1, 2))""")
_feed_query("feed_financials", "financials", f"""SELECT p_brand AS symbol, 'annual' AS frequency, CAST(y AS INTEGER) AS year, NULL::INTEGER AS quarter,
  NULL::VARCHAR AS form, s AS start_date, e AS end_date, NULL::TIMESTAMP AS filed_date, NULL::TIMESTAMP AS accepted_date, {BATCH_LIT} AS batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY y DESC) AS rn FROM (
    SELECT p_brand, year(l_shipdate) AS y, date_trunc('second', min(l_shipdate)) AS s, date_trunc('second', max(l_shipdate)) AS e
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))""")
_feed_query("feed_insider", "insider", f"""SELECT 'S' || l_suppkey AS symbol, CAST(l_orderkey AS VARCHAR) AS person_name, CAST(l_partkey AS DOUBLE) AS share,
  CAST(trunc(l_quantity) AS DOUBLE) AS change, CAST(l_shipdate AS DATE) AS filing_date, CAST(l_shipdate AS DATE) AS transaction_date,
  l_returnflag AS transaction_code, {BATCH_LIT} AS batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate)
    ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag) AS rn FROM lineitem)""")
_SOC = ", ".join(
    f"""CASE WHEN {s}_n > 0 THEN {s}_n ELSE 0 END AS {s}_mention, CASE WHEN {s}_n > 0 THEN {s}_pos ELSE 0 END AS {s}_positive_mention,
  CASE WHEN {s}_n > 0 THEN {s}_neg ELSE 0 END AS {s}_negative_mention, CASE WHEN {s}_n > 0 THEN {sr4(f'{s}_score')} ELSE 0.0 END AS {s}_score"""
    for s in ("reddit", "twitter"))
_SOC_AGG = ", ".join(
    f"""CAST(sum(CAST(user_id % 2 = {par} AS BIGINT)) AS BIGINT) AS {s}_n,
  CAST(sum(CAST(user_id % 2 = {par} AND value >= 50 AS BIGINT)) AS BIGINT) AS {s}_pos,
  CAST(sum(CAST(user_id % 2 = {par} AND value < 50 AS BIGINT)) AS BIGINT) AS {s}_neg,
  avg(CASE WHEN user_id % 2 = {par} THEN value END) AS {s}_score"""
    for s, par in (("reddit", 0), ("twitter", 1)))
_feed_query("feed_social", "social", f"""SELECT sym AS symbol, {_SOC}, CAST(d AS TIMESTAMP) AS timestamp, strftime(d, '%Y%m%d') || '_000000' AS batch_id
  FROM (SELECT event_type AS sym, CAST(ts AS DATE) AS d, {_SOC_AGG} FROM events GROUP BY 1, 2)""",
            dbl=["reddit_score", "twitter_score"])
_feed_query("feed_ipo", "ipo", f"""SELECT NULL::DATE AS date, p_brand AS exchange, p_name AS name, CAST(p_size AS DOUBLE) AS number_of_shares,
  CAST(p_retailprice AS VARCHAR) AS price, p_type AS status, 'P' || p_partkey AS symbol, {sr4('p_size * p_retailprice')} AS total_shares_value,
  {BATCH_LIT} AS batch_id FROM part""", dbl=["total_shares_value"])


@query("feed_quarantine", f"""SELECT 'profile' AS feed, CAST(page_id AS VARCHAR) AS symbol, {BATCH_LIT} AS batch_id,
  CASE WHEN html IS NULL OR trim(html) = '' THEN 'empty_body' WHEN NOT json_valid(html) THEN 'malformed_json' END AS reason
  FROM pages WHERE html IS NULL OR trim(html) = '' OR NOT json_valid(html)""")
def q_feed_quarantine(spark, sf):
    """Unusable landing rows of all feeds with a reason."""
    return FD.quarantine(B.landing_all(spark, sf)).select("feed", "symbol", "batch_id", "reason")


@query("feed_no_data", f"""SELECT 'quote' AS feed, event_type AS symbol, strftime(CAST(ts AS DATE), '%Y%m%d') || '_000000' AS batch_id
  FROM events WHERE props IS NOT NULL AND json_valid(props) AND NOT json_exists(props, '$.c')
  UNION ALL SELECT 'candle', symbol, {BATCH_LIT} FROM (SELECT DISTINCT event_type AS symbol FROM events)""")
def q_feed_no_data(spark, sf):
    """Valid responses without data for their feed (the reference's
    "no data returned" warnings), over all landed stand-ins."""
    return FD.no_data(B.landing_all(spark, sf)).select("feed", "symbol", "batch_id")


@query("symbol_list", "SELECT p_partkey, trim(s) AS symbol FROM part, unnest(string_split(replace(p_name, ' ', ' , '), ',')) AS t(s)")
def q_symbol_list(spark, sf):
    """Comma-separated symbol lists (part names spaced with commas) split and trimmed."""
    p = B.read(spark, sf, "part").select("p_partkey", F.regexp_replace("p_name", " ", " , ").alias("cfg"))
    return p.select("p_partkey", F.explode(P.parse_symbols(F.col("cfg"))).alias("symbol"))


@query("date_window", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-17' - 90 AND DATE '1995-06-17' + 30")
def q_date_window(spark, sf):
    """Look-back 90 days, look-ahead 30 days around a fixed as-of date."""
    o = B.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return P.date_window(o, "o_orderdate", 90, 30, "1995-06-17")


@query("union_batches", with_(cte("b1", B1), cte("b2", B2), body=f"""SELECT symbol, date, {sql_r4(['close'])}, batch_id, n_days FROM (
  SELECT *, 'events' AS batch_id, NULL::BIGINT AS n_days FROM b1 UNION ALL BY NAME
  SELECT *, 'brand' AS batch_id, CAST(count(*) OVER (PARTITION BY symbol) AS BIGINT) AS n_days FROM b2)"""))
def q_union_batches(spark, sf):
    """Union by name of batches whose schemas differ."""
    a = B.bars_events(spark, sf).withColumn("batch_id", F.lit("events"))
    b2 = B.bars_brand(spark, sf)
    counts = b2.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_days"))
    b = b2.join(counts, "symbol").withColumn("batch_id", F.lit("brand"))
    return rounded(S.union_batches(a, b).select("symbol", "date", "close", "batch_id", "n_days"))


def _feed_counts_sql():
    parts = {
        "quotes": "SELECT batch_id FROM b3",
        "historical": f"SELECT {BATCH_LIT} AS batch_id FROM b1",
        "profiles": f"SELECT {BATCH_LIT} AS batch_id FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "news": f"SELECT {BATCH_LIT} AS batch_id FROM (SELECT row_number() OVER (PARTITION BY lang, floor(doc_id / 16) ORDER BY doc_id) AS rn FROM documents)",
        "earnings": f"SELECT {BATCH_LIT} AS batch_id FROM qt",
        "financials": f"SELECT {BATCH_LIT} AS batch_id FROM (SELECT row_number() OVER (PARTITION BY p_brand ORDER BY y DESC) AS rn FROM (SELECT DISTINCT p_brand, year(l_shipdate) AS y FROM lineitem JOIN part ON l_partkey = p_partkey))",
        "insider": f"SELECT {BATCH_LIT} AS batch_id FROM (SELECT row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate) ORDER BY l_orderkey) AS rn FROM lineitem)",
        "recommendations": f"SELECT {BATCH_LIT} AS batch_id FROM (SELECT row_number() OVER (PARTITION BY o_orderstatus ORDER BY m DESC) AS rn FROM (SELECT DISTINCT o_orderstatus, date_trunc('month', o_orderdate) AS m FROM orders))",
        "sentiment": "SELECT DISTINCT event_type, strftime(CAST(ts AS DATE), '%Y%m%d') || '_000000' AS batch_id FROM events",
        "dividends": f"SELECT {BATCH_LIT} AS batch_id FROM qt",
        "market_news": f"SELECT {BATCH_LIT} AS batch_id FROM (SELECT row_number() OVER (PARTITION BY floor(doc_id / 32) ORDER BY doc_id) AS rn FROM documents)",
        "ipo_calendar": f"SELECT {BATCH_LIT} AS batch_id FROM part",
    }
    return " UNION ALL ".join(f"SELECT batch_id, '{k}' AS feed, count(*) AS rows FROM ({v}) GROUP BY batch_id" for k, v in parts.items())


@query("ingest_summary", with_(cte("b1", B1), cte("b3", B3), cte("qt", QUARTERS), body=_feed_counts_sql()))
def q_ingest_summary(spark, sf):
    """Rows per (batch, feed) over all 12 normalized feed tables."""
    tables = FD.normalize_all(B.landing_all(spark, sf, junk=False))
    return FD.ingest_counts(tables)


_KINDS_JSON = "[" + ",".join(f'"{k}"' for k in FD.SUMMARY_KEYS.values()) + "]"


@query("ingest_status", with_(cte("b1", B1), cte("b3", B3), cte("qt", QUARTERS), cte("fc", _feed_counts_sql()),
                              cte("per", """SELECT b.batch_id, b.files_created, coalesce(s.syms, []::VARCHAR[]) AS syms FROM
  (SELECT batch_id, count(*) AS files_created FROM fc GROUP BY batch_id) b
  LEFT JOIN (SELECT batch_id, list(symbol ORDER BY symbol) AS syms FROM (SELECT DISTINCT batch_id, symbol FROM b3) GROUP BY batch_id) s
  USING (batch_id)"""),
                              body=f"""SELECT 'data_ingest' AS service, batch_id, field, value FROM (
  SELECT batch_id, 'status' AS field, 'completed' AS value FROM per
  UNION ALL SELECT batch_id, 'message', 'Successfully fetched comprehensive data for ' || len(syms) || ' symbols' FROM per
  UNION ALL SELECT batch_id, 'symbols_fetched', CAST(to_json(syms) AS VARCHAR) FROM per
  UNION ALL SELECT batch_id, 'files_created', CAST(files_created AS VARCHAR) FROM per
  UNION ALL SELECT batch_id, 'data_types', '{_KINDS_JSON}' FROM per)"""))
def q_ingest_status(spark, sf):
    """Status rows of the ingest service per batch (T03 source); the quotes
    table has two readers (counts, fetched symbols) and is read as written."""
    tables = FD.normalize_all(B.landing_all(spark, sf, junk=False))
    tables["quotes"] = materialize(tables["quotes"], "quotes-table")
    summ = FD.ingest_summary(tables, quotes=tables["quotes"])
    return ST.ingest_status(summ)


@query("fetched_symbols", with_(*QUOTE_SRC, body="SELECT DISTINCT batch_id, symbol FROM b3"))
def q_fetched_symbols(spark, sf):
    """Symbols whose quote succeeded, per batch (F19), long form."""
    return FD.fetched_symbols(FD.normalize_quote(B.landing_quote(spark, sf)))


# ====================================================================== storage

@query("csv_roundtrip", with_(*QUOTE_SRC, body=f"SELECT symbol, {sql_r4(NUM_Q)}, timestamp, batch_id FROM b3"))
def q_csv_roundtrip(spark, sf):
    """Quotes written as partitioned CSV to the shared folder and read back
    with an explicit schema (S01, S08)."""
    q = B.quotes_events(spark, sf)
    path = scratch(spark, "quotes-csv")
    S.write_table(q, path, fmt="csv")
    back = S.read_table(spark, path, q.schema, fmt="csv")
    return rounded(back.select(*QUOTE_COLS), keep=())


_FILES = ("SELECT 'stock_quotes_' || batch_id || '.csv' AS file_name FROM (SELECT DISTINCT batch_id FROM b3) "
          "UNION ALL SELECT 'stock_historical_' || strftime(date, '%Y%m%d') || '_000000.csv' FROM (SELECT DISTINCT date FROM b1)")


def _files(spark, sf):
    q = B.quotes_events(spark, sf).select(F.concat(F.lit("stock_quotes_"), "batch_id", F.lit(".csv")).alias("file_name")).distinct()
    h = B.bars_events(spark, sf).select(F.concat(F.lit("stock_historical_"), B.batch_id_of(F.col("date")),
                                                 F.lit(".csv")).alias("file_name")).distinct()
    return q.unionByName(h)


@query("parse_batch", with_(*QUOTE_SRC, cte("files", _FILES), body="""SELECT file_name,
  CASE WHEN contains(file_name, 'stock_quotes_') THEN 'quotes' ELSE 'historical' END AS kind,
  regexp_extract(file_name, '_(\\d{8}_\\d{6})\\.csv$', 1) AS batch_id,
  strptime(regexp_extract(file_name, '_(\\d{8}_\\d{6})\\.csv$', 1), '%Y%m%d_%H%M%S') AS batch_ts FROM files"""))
def q_parse_batch(spark, sf):
    """Kind, batch id and batch time out of file names."""
    f = _files(spark, sf)
    return rounded(f.select("file_name", S.parse_batch(F.col("file_name")).alias("p")).select("file_name", "p.*"))


@query("pending_batches", with_(*QUOTE_SRC, CLEAN_QUOTES, cte("files", _FILES), body="""SELECT kind, batch_id FROM (
  SELECT DISTINCT CASE WHEN contains(file_name, 'stock_quotes_') THEN 'quotes' ELSE 'historical' END AS kind,
    regexp_extract(file_name, '_(\\d{8}_\\d{6})\\.csv$', 1) AS batch_id FROM files)
  WHERE (kind, batch_id) NOT IN (SELECT DISTINCT ('quotes', batch_id) FROM cq)"""))
def q_pending_batches(spark, sf):
    """Raw batch files (quotes and historical) minus the batches present in
    the processed quotes table, by (kind, batch_id) (S05)."""
    f = _files(spark, sf)
    raw = f.select(S.parse_batch(F.col("file_name")).alias("p")).select("p.kind", "p.batch_id")
    done = R.clean_quotes(B.quotes_events(spark, sf)).select(F.lit("quotes").alias("kind"), "batch_id")
    return S.pending_batches(raw, done)


@query("retention", with_(*QUOTE_SRC, body=f"SELECT symbol, batch_id, {sr4('current_price')} AS current_price FROM b3 WHERE timestamp >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY"))
def q_retention(spark, sf):
    """Quotes no older than 7 days before 2024-01-30."""
    q = B.quotes_events(spark, sf).withColumnRenamed("timestamp", "batch_ts")
    return rounded(S.retain(q, 7, "2024-01-30 00:00:00").select("symbol", "batch_id", "current_price"))


# ====================================================================== streaming

@query("stream_clean", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT {_cq_select()} FROM cq"))
def q_stream_clean(spark, sf):
    """Quote batches landed as Parquet files, cleaned by a file stream
    (availableNow, checkpointed) into a partitioned table, read back (T01)."""
    q = B.quotes_events(spark, sf)
    base = scratch(spark, "stream-clean")
    q.write.partitionBy("batch_id").parquet(f"{base}/src")
    query_ = ST.stream_clean(spark, f"{base}/src", f"{base}/dst", f"{base}/ckpt", q.schema, R.clean_quotes)
    query_.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/dst").select(*CQ_COLS))


@query("event_filter", "SELECT event_type AS event, CAST(ts AS TIMESTAMP) AS timestamp, user_id, value FROM events WHERE event_type IN ('purchase', 'signup')")
def q_event_filter(spark, sf):
    """Event messages (events as JSON plus raw pages as malformed messages)
    filtered by type; malformed ones are skipped (T02)."""
    ev = B.read(spark, sf, "events")
    msgs = ST.to_message(ev.select(F.col("event_type").alias("event"), F.col("ts").alias("timestamp"),
                                   "user_id", "value"))
    junk = B.read(spark, sf, "pages").select(F.col("html").alias("message"))
    schema = T.StructType([*ST.MESSAGE_SCHEMA.fields, T.StructField("user_id", T.LongType()),
                           T.StructField("value", T.DoubleType())])
    out = ST.event_filter(msgs.unionByName(junk), ["purchase", "signup"], schema=schema)
    return rounded(out.select("event", "timestamp", "user_id", "value"), keep=("value",))


@query("event_quarantine", "SELECT page_id, CASE WHEN html IS NULL OR trim(html) = '' THEN 'empty_message' WHEN NOT json_valid(html) THEN 'malformed_json' END AS reason FROM pages WHERE html IS NULL OR trim(html) = '' OR NOT json_valid(html) UNION ALL SELECT event_id, 'no_event' FROM events WHERE props IS NOT NULL AND json_valid(props)")
def q_event_quarantine(spark, sf):
    """Messages that are no events with the reason: raw pages, and event properties
    (JSON without an event) (P13, T02)."""
    pages = B.read(spark, sf, "pages").select("page_id", F.col("html").alias("message"))
    props = B.read(spark, sf, "events").where("props IS NOT NULL").select(F.col("event_id").alias("page_id"),
                                                                         F.col("props").alias("message"))
    return ST.event_quarantine(pages.unionByName(props)).select("page_id", "reason")


@query("stream_dedup", "SELECT event_id, ts, event_type, value FROM events")
def q_stream_dedup(spark, sf):
    """Events landed twice for days 5 and 6, de-duplicated by a watermarked
    stream (T05)."""
    ev = B.read(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    base = scratch(spark, "stream-dedup")
    ev.unionByName(ev.where(F.dayofmonth("ts").isin(5, 6))).write.parquet(f"{base}/src")
    s = spark.readStream.schema(ev.schema).parquet(f"{base}/src")
    q = (ST.stream_dedup(s, ["event_id"], "ts").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start(f"{base}/dst"))
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/dst"), keep=("value",))


from . import catalog_runs  # noqa: E402, F401  (adds its queries)
