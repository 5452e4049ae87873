"""Queries of runs, states and event-driven jobs: what later runs see of earlier ones. They use the
catalogue's conventions and are added to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental as INC
from ..operators import indicators as I
from ..operators import sketches as SK
from ..operators.carry import carry_prices
from ..session import materialize
from ..sources import bindings as B
from ..sources import commits
from ..sources import feeds as FD
from ..sources import rescue
from ..sources import storage as S
from ..streaming import streams as ST
from . import sqlparts as SP
from .catalog import CQ_COLS, ORACLE, QUOTE_SRC, _cq_select, query, r4, rounded, scratch, sql_r4
from .jobs import run_ingest
from .sqlparts import B2, B6, B7, B8, CLEAN_QUOTES, cte, r4 as sr4, with_


# ====================================================================== committed runs

@query("committed_runs", with_(cte("b7", B7), body=f"""
SELECT batch_id, count(*) AS rows, count(current_price) AS priced, max({sr4('current_price')}) AS high FROM (
  SELECT batch_id, CASE WHEN batch_id LIKE '1993%' THEN -current_price ELSE current_price END AS current_price
  FROM b7 WHERE batch_id NOT LIKE '1995%' AND batch_id >= '19920701_000000') GROUP BY 1"""))
def q_committed_runs(spark, sf):
    """What readers see of a store after five runs (a quote per line item): the batches before 1995; a run over 1995
    that dies before its commit; the batches from 1996 on, committed twice under one id; 1993 once
    more with other prices; and the removal of what is older than 1992-07."""
    q, root = materialize(B.quotes_lines(spark, sf), "runs-quotes"), scratch(spark, "store")
    by = {"quotes": ["batch_id"]}

    def run(rows, run_id, job="quotes"):
        commits.stage_rows(rows, root, "quotes", run_id)
        return commits.commit(spark, root, run_id, job, by)

    run(q.where("batch_id < '1995'"), "r1")
    commits.stage_rows(q.where("batch_id LIKE '1995%'"), root, "quotes", "r2")
    run(q.where("batch_id >= '1996'"), "r3")
    run(q.where("batch_id >= '1996'"), "r3")
    run(q.where("batch_id LIKE '1993%'").withColumn("current_price", -F.col("current_price")), "r4")
    commits.expire(spark, root, "quotes", 31, "1992-08-01 00:00:00")
    commits.vacuum(spark, root, "quotes", 0)
    commits.compact_log(spark, root)
    t = commits.read(spark, root, "quotes")
    return t.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.count("current_price").alias("priced"),
                                     F.max(r4("current_price")).alias("high"))


# ====================================================================== state across batches

@query("indicators_incremental", with_(cte("b2", B2), SP.indicator_ctes("b2", "ind"),
                                       body=f"SELECT symbol, date, {sql_r4(['close'] + SP.INDICATORS)} FROM ind"))
def q_indicators_incremental(spark, sf):
    """All 13 indicators of every brand series, computed in three batches by date; each reads its own rows and the
    state that the batch before left."""
    bars, root, state, parts = materialize(B.bars_brand(spark, sf), "bars"), scratch(spark, "incremental"), None, []
    for k, dates in enumerate(("date < '1994-06-01'", "date >= '1994-06-01' AND date < '1998-10-01'", "date >= '1998-10-01'")):
        out, state = INC.indicators_incremental(bars.where(dates), state)
        out.write.parquet(f"{root}/rows/batch={k}")
        state.write.parquet(f"{root}/state-{k}")
        state = spark.read.parquet(f"{root}/state-{k}")
        parts.append(f"{root}/rows/batch={k}")
    return rounded(spark.read.parquet(*parts).select("symbol", "date", "close", *I.INDICATOR_COLUMNS))


@query("indicators_incremental_gaps", with_(
    cte("b2", B2), cte("g", "SELECT * REPLACE (CASE WHEN year(date) <> 1994 THEN close END AS close) FROM b2"),
    SP.indicator_ctes("g", "ind"), body=f"SELECT symbol, date, {sql_r4(['ema_12', 'macd', 'macd_signal', 'rsi', 'sma_5'])} FROM ind"))
def q_indicators_incremental_gaps(spark, sf):
    """The same over series whose prices miss for a year, with batch borders inside the gap and at its end."""
    b = B.bars_brand(spark, sf).withColumn("close", F.when(F.year("date") != 1994, F.col("close")))
    bars, root, state, parts = materialize(b, "bars"), scratch(spark, "incremental"), None, []
    for k, dates in enumerate(("date < '1994-06-01'", "date >= '1994-06-01' AND date < '1995-01-01'", "date >= '1995-01-01'")):
        out, state = INC.indicators_incremental(bars.where(dates), state)
        out.write.parquet(f"{root}/rows/batch={k}")
        state.write.parquet(f"{root}/state-{k}")
        state = spark.read.parquet(f"{root}/state-{k}")
        parts.append(f"{root}/rows/batch={k}")
    return rounded(spark.read.parquet(*parts).select("symbol", "date", "ema_12", "macd", "macd_signal", "rsi", "sma_5"))


# B7 with a quote's own moment, so that rows of equal time differ in price only, and few prices in the first half of a month
_SPARSE = """SELECT symbol, timestamp, batch_id, CASE WHEN day(timestamp) > 15 OR day(timestamp) = 7 THEN current_price END AS current_price
  FROM (SELECT DISTINCT * FROM b7)"""


def _sparse(spark, sf):
    q = B.quotes_lines(spark, sf).distinct()
    day = F.dayofmonth("timestamp")
    return q.select("symbol", "timestamp", "batch_id", F.when((day > 15) | (day == 7), F.col("current_price")).alias("current_price"))


@query("carry_prices", with_(
    cte("b7", B7), cte("s", _SPARSE),
    cte("f", """SELECT *, last_value(current_price IGNORE NULLS) OVER (PARTITION BY batch_id, symbol
        ORDER BY timestamp, current_price NULLS FIRST ROWS UNBOUNDED PRECEDING) AS filled FROM s"""),
    cte("k", """SELECT symbol, batch_id, arg_max(current_price, (timestamp, current_price)) FILTER (WHERE current_price IS NOT NULL) AS last
        FROM s GROUP BY 1, 2"""),
    cte("p", """SELECT symbol, batch_id, last_value(last IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY batch_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM k"""),
    body=f"""SELECT symbol, timestamp, batch_id, {sr4('coalesce(filled, known)')} AS current_price FROM f JOIN p USING (symbol, batch_id)"""))
def q_carry_prices(spark, sf):
    """Prices carried into a batch from the newest earlier batch that has one, in two runs: the months before 1995, then
    the others with the last-known table of the first run."""
    q = materialize(_sparse(spark, sf), "carry-quotes")
    early, known = carry_prices(q.where("batch_id < '1995'"))
    late, _ = carry_prices(q.where("batch_id >= '1995'"), materialize(known, "carry-known"))
    return rounded(early.unionByName(late))


# ====================================================================== sketches and data skipping

@query("median_sketch", with_(cte("b7", B7), body="""
SELECT batch_id, c AS column_name, count(v) AS n, true AS within FROM (
  SELECT batch_id, unnest(['previous_close', 'change']) AS c, unnest([previous_close, change]) AS v FROM b7)
GROUP BY 1, 2 HAVING count(v) > 0"""))
def q_median_sketch(spark, sf):
    """Medians of monthly batches from sketches that three loads of the line items' quotes left and a merge joined; the
    rank of each, counted over all values, is within the sketches' bound."""
    q = B.quotes_lines(spark, sf)
    cols = ["previous_close", "change"]
    load = F.pmod(F.xxhash64(*q.columns), F.lit(3))
    stored = None
    for k in range(3):
        s = SK.value_sketches(q.where(load == k), cols)
        stored = s if stored is None else stored.unionByName(s)
    merged = SK.merge_sketches(materialize(stored, "sketches"))
    med = merged.select("batch_id", F.col("_mf_col").alias("column_name"), "n",
                        F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"))
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("kv")
    long = q.select(F.col("batch_id").alias("b"), kv).select("b", "kv.c", "kv.v").where("v IS NOT NULL")
    ranks = long.join(med, (F.col("b") == F.col("batch_id")) & (F.col("c") == F.col("column_name"))).groupBy(
        "batch_id", "column_name").agg(F.max("n").alias("n"), F.count(F.when(F.col("v") < F.col("median"), 1)).alias("below"),
                                       F.count(F.when(F.col("v") <= F.col("median"), 1)).alias("upto"))
    slack = 2 * SK.rank_error() * F.col("n") + 1     # three merged sketches, and the bound holds with 99 %
    return ranks.select("batch_id", "column_name", "n",
                        ((F.col("below") - slack <= F.col("n") / 2) & (F.col("upto") + slack >= F.col("n") / 2)).alias("within"))


@query("clustered_symbol", with_(cte("b2", B2), cte("b8", B8), body=f"""SELECT symbol, date, batch_id, {sr4('close')} AS close FROM b8
    WHERE symbol IN ('Brand#11', 'Brand#34')"""))
def q_clustered_symbol(spark, sf):
    """Two symbols out of brand bars in yearly batches, stored by symbol with Bloom filters: the filter skips
    row groups by their statistics."""
    path = scratch(spark, "clustered")
    S.write_clustered(B.bars_brand_gaps(spark, sf), path)
    t = spark.read.parquet(path).where(F.col("symbol").isin("Brand#11", "Brand#34"))
    return rounded(t.select("symbol", "date", F.col("batch_id").cast("string").alias("batch_id"), "close"))


# ====================================================================== rescued fields

@query("feed_rescued", """
SELECT 'insider' AS feed, 'S' || l_suppkey AS symbol, '$.data[*]' AS path, unnest(['price', 'filing']) AS key,
       unnest([CASE WHEN l_linenumber = 7 THEN '"' || CAST(round(l_extendedprice * 100) AS BIGINT) || '"'
                    ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) END,
               '{"flag":"' || l_returnflag || '","status":"' || l_linestatus || '"}']) AS value FROM lineitem
UNION ALL SELECT 'insider', s, '$', 'symbol', '"' || s || '"' FROM (SELECT DISTINCT 'S' || l_suppkey AS s, year(l_shipdate) FROM lineitem)
UNION ALL SELECT 'quote', event_type, '$', unnest(json_keys(props)), json_extract_string(props, '$.k') FROM events""")
def q_feed_rescued(spark, sf):
    """Keys beyond the schemas, as values of any type: of insider responses (line items with more keys than are
    read, a list's and the body's) and of quote responses without a price."""
    t = rescue.rescued_fields(B.landing_wide(spark, sf), ["quote", "insider"])
    return t.select("feed", "symbol", "path", "key", F.to_json("value").alias("value"))


@query("schema_drift", """
WITH i AS (SELECT strftime(l_shipdate, '%Y') || '0101_000000' AS batch_id, max((l_linenumber = 7)::INT) AS texts, count(*) - count(*) FILTER (WHERE l_linenumber = 7) AS numbers,
              count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1),
d AS (SELECT batch_id, 'insider' AS feed, '$.data[*]' AS path, 'price' AS key,
             CASE WHEN texts = 0 THEN 'BIGINT' WHEN numbers = 0 THEN 'STRING' ELSE 'VARIANT' END AS type, n AS rows FROM i
      UNION ALL SELECT batch_id, 'insider', '$.data[*]', 'filing', 'OBJECT<flag: STRING, status: STRING>', n FROM i
      UNION ALL SELECT batch_id, 'insider', '$', 'symbol', 'STRING', suppliers FROM i
      UNION ALL SELECT strftime(ts, '%Y%m%d') || '_000000', 'quote', '$', 'k', 'BIGINT', count(*) FROM events GROUP BY 1)
SELECT *, lag(type) OVER (PARTITION BY feed, path, key ORDER BY batch_id) AS before FROM d""")
def q_schema_drift(spark, sf):
    """Unread keys per batch with the merged type of their values and the type of the batch before."""
    return rescue.schema_drift(rescue.rescued_fields(B.landing_wide(spark, sf), ["quote", "insider"]))


# ====================================================================== event-driven runs and streams

def _land_csv(spark, df, folder, prefix):
    """One headered CSV file per batch in ``folder``, named as raw files are."""
    tmp = f"{folder}-parts"
    df.repartition("batch_id").write.partitionBy("batch_id").option("header", "true").csv(tmp)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(tmp).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for d in fs.listStatus(path(tmp)):          # a folder per batch
        name = d.getPath().getName()
        if name.startswith("batch_id="):
            part = next(f.getPath() for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-"))
            fs.rename(part, path(f"{folder}/{prefix}{name.removeprefix('batch_id=')}.csv"))


@query("event_cleaning", with_(*QUOTE_SRC, CLEAN_QUOTES, body=f"SELECT {_cq_select()} FROM cq"))
def q_event_cleaning(spark, sf):
    """Raw CSV files of the quote batches, cleaned by the consumer of an event channel: a message of another kind, two
    that announce data and a malformed one give one committed run, whose processed quotes are read back (T02, S01, S05, C09)."""
    base = scratch(spark, "events run")         # a name with a space, as folders may have
    _land_csv(spark, B.quotes_events(spark, sf), f"{base}/raw", "stock_quotes_")
    lines = ['{"event": "something_else"}', *[f'{{"event": "{e}"}}' for e in ST.INGEST_EVENTS], "not json"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/events")
    ST.clean_on_events(spark, f"{base}/events", f"{base}/raw", f"{base}/store", f"{base}/ckpt").awaitTermination()
    return rounded(commits.read(spark, f"{base}/store", "processed_quotes").select(*CQ_COLS))


@query("ingest_run", ORACLE["ingest_summary"])
def q_ingest_run(spark, sf):
    """The ingest job over the landed stand-ins of all feeds, in one committed run: rows per (batch, feed) of the tables
    that readers then see (F18, S08)."""
    root = scratch(spark, "ingest-run")
    run_ingest(spark, B.landing_all(spark, sf, junk=False), root)
    tables = {name: commits.read(spark, root, name) for name in FD.FEED_TABLES.values()}
    return FD.ingest_counts({name: t for name, t in tables.items() if t is not None})


@query("status_stream", with_(cte("b6", B6), body="""SELECT service, field, arg_max_null(value, (ts, seq)) AS value,
    CAST(max(ts) AS TIMESTAMP) AS ts FROM b6 GROUP BY 1, 2"""))
def q_status_stream(spark, sf):
    """The status log as a stream of three files, one a micro-batch, kept as the current value of each field."""
    log, base = B.status_log(spark, sf), scratch(spark, "status")
    for k in range(3):
        log.where(F.pmod(F.col("seq"), F.lit(3)) == k).coalesce(1).write.parquet(f"{base}/log/{k}")
    src = spark.readStream.schema(ST.STATUS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/log/*")
    ST.stream_status(src, f"{base}/store", f"{base}/ckpt").awaitTermination()
    t = commits.read(spark, f"{base}/store", "status_current")
    return t.select("service", "field", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("stream_dedup_store", "SELECT event_id, ts, event_type, value FROM events")
def q_stream_dedup_store(spark, sf):
    """Events in file order by day, those of days 5 and 6 landed again at the end, far behind the watermark: the
    copies are found among the stored keys (T05)."""
    ev, base = B.read(spark, sf, "events").select("event_id", "ts", "event_type", "value"), scratch(spark, "dedup")
    for k, part in enumerate((ev.where("day(ts) <= 10"), ev.where("day(ts) > 10"), ev.where("day(ts) IN (5, 6)"))):
        part.coalesce(1).write.parquet(f"{base}/src/{k}")
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    ST.stream_dedup_store(src, ["event_id"], "ts", f"{base}/dst", f"{base}/seen", f"{base}/ckpt").awaitTermination()
    return rounded(spark.read.parquet(f"{base}/dst").select("event_id", "ts", "event_type", "value"), keep=("value",))


@query("json_roundtrip", with_(cte("b7", B7), body=f"""SELECT symbol, batch_id, {sr4('current_price')} AS current_price,
    {sr4('previous_close')} AS previous_close, timestamp FROM b7"""))
def q_json_roundtrip(spark, sf):
    """Quotes written as JSON documents and read back with their schema."""
    q, path = B.quotes_lines(spark, sf), scratch(spark, "json")
    S.write_summary(q, path)
    t = spark.read.schema(q.schema).json(path)
    return rounded(t.select("symbol", "batch_id", "current_price", "previous_close", "timestamp"))
