"""Dashboard queries (V01-V19): the rows behind each chart, KPI and table.

Chart drawing is not built. Every query is a grouped aggregate, a projection
or a semi-join; "latest" picks use a grouped max joined back (never a window
over a whole symbol) or a scalar subquery (runtime partition pruning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ensure_symbol, label, project_available, round_numeric, with_default
from .series import IDX, series_index

# Sentiment colours, default gray (reference dashboard).
SENTIMENT_COLORS = {"Strong Bullish": "darkgreen", "Bullish": "lightgreen",
                    "Bearish": "lightcoral", "Strong Bearish": "darkred"}
# Indicator columns shown on the technical tab, in order.
TECHNICAL_COLUMNS = ["sma_5", "sma_20", "ema_12", "ema_26", "macd", "rsi", "bb_upper",
                     "bb_lower", "volatility"]
# Series drawn on the price chart, in drawing order.
CHART_SERIES = ["open", "high", "low", "close", "sma_20", "ema_12", "bb_upper", "bb_lower",
                "rsi", "macd", "volume"]


def latest_batch(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of the newest batch (S06, V16). The newest id is a scalar
    subquery in the filter: on a table partitioned by ``batch_id`` it is a
    partition filter evaluated before file listing, so only the newest
    partition is read."""
    return df.where(F.col(batch) == df.select(F.max(batch)).scalar())


def prefer_processed(processed: DataFrame, raw: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Latest processed batch if any processed batch exists, else latest raw.
    Two scalar subqueries; each side is pruned to one batch at runtime."""
    top_p = processed.select(F.max(batch)).scalar()
    top_r = raw.select(F.max(batch)).scalar()
    use_p = processed.where(F.col(batch) == top_p)
    use_r = raw.where(top_p.isNull() & (F.col(batch) == top_r))
    return use_p.unionByName(use_r, allowMissingColumns=True)


def sentiment_counts(df: DataFrame) -> DataFrame:
    """Value counts of sentiment with its colour, most frequent first, equal counts by
    name (V02, V03); nulls excluded. At most one row per sentiment is sorted."""
    cmap = F.create_map(*[F.lit(x) for kv in SENTIMENT_COLORS.items() for x in kv])
    return (df.where(F.col("sentiment").isNotNull())
              .groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))
              .withColumn("color", F.coalesce(F.element_at(cmap, F.col("sentiment")), F.lit("gray")))
              .orderBy(F.col("count").desc(), "sentiment"))


def change_bars(df: DataFrame) -> DataFrame:
    """symbol, change_percent, green if > 0 else red (null -> red)."""
    return df.select("symbol", "change_percent",
                     F.when(F.col("change_percent") > 0, F.lit("green")).otherwise(F.lit("red")).alias("color"))


def volume_bars(quotes: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """symbol, volume (V05). Quotes carry no volume, so with ``bars`` the
    volume of each symbol's latest bar is joined in (grouped max_by)."""
    if "volume" in quotes.columns or bars is None:
        return project_available(quotes, ["symbol", "volume"])
    last = bars.groupBy("symbol").agg(F.max_by("volume", "date").alias("volume"))
    return quotes.select("symbol").join(last, "symbol", "left")


def metrics_table(df: DataFrame) -> DataFrame:
    """symbol, current_price, change_percent, volume (available ones), 2 places."""
    return round_numeric(project_available(df, ["symbol", "current_price", "change_percent", "volume"]), 2)


def recent_quotes(df: DataFrame) -> DataFrame:
    """Recent-data table incl. sentiment, 2 places."""
    return round_numeric(project_available(
        df, ["symbol", "current_price", "change_percent", "volume", "sentiment"]), 2)


def market_kpis(df: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Average price, market trend (average change %), total volume, active stocks
    (V07). Quotes carry no volume, so with ``bars`` it is that of each symbol's
    latest bar."""
    if "volume" not in df.columns and bars is not None:
        last = bars.groupBy(F.col("symbol").alias("_mf_s")).agg(F.max_by("volume", "date").alias("volume"))
        df = df.join(last, F.col("symbol") == F.col("_mf_s"), "left").drop("_mf_s")
    vol = F.sum("volume") if "volume" in df.columns else F.lit(None).cast("double")
    return df.agg(F.avg("current_price").alias("avg_price"),
                  F.avg("change_percent").alias("market_trend"),
                  vol.alias("total_volume"),
                  F.count(F.lit(1)).alias("active_stocks"))


def available_symbols(df: DataFrame) -> DataFrame:
    """Distinct symbols over all batches."""
    return df.select("symbol").where(F.col("symbol").isNotNull()).distinct()


def latest_series(df: DataFrame, batch: str = "batch_id", key: str = "symbol") -> DataFrame:
    """Each symbol's rows from the newest batch containing it (V10), all
    symbols at once: grouped max per symbol, semi-joined back."""
    newest = df.groupBy(key).agg(F.max(batch).alias("_mf_nb"))
    cond = (df[key] == newest[key]) & (df[batch] == newest["_mf_nb"])
    return df.join(newest, cond, "left_semi")


def symbol_kpis(df: DataFrame, key: str = "symbol", order: str = "date") -> DataFrame:
    """Last close, mean volume, last volatility, last RSI per symbol.
    ``max_by`` keeps a null last value, as ``iloc[-1]`` does."""
    return df.groupBy(key).agg(
        F.max_by("close", order).alias("current_price"),
        F.avg("volume").alias("avg_volume"),
        F.max_by("volatility", order).alias("volatility"),
        F.max_by("rsi", order).alias("rsi"))


def indicator_latest(df: DataFrame, cols: Sequence[str] = TECHNICAL_COLUMNS,
                     key: str = "symbol", order: str = "date") -> DataFrame:
    """Long form: last value of each indicator per symbol, only indicators
    not all-null for that symbol, with display label (V13)."""
    df = ensure_symbol(df) if key == "symbol" else df
    cols = [c for c in cols if c in df.columns]
    agg = df.groupBy(key).agg(*[F.max_by(c, order).alias(f"v_{c}") for c in cols],
                              *[F.count(c).alias(f"n_{c}") for c in cols])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(f"v_{c}").alias("value"),
                                         F.col(f"n_{c}").alias("n")) for c in cols])).alias("p")
    return (agg.select(key, pairs)
               .where(F.col("p.n") > 0)
               .select(key, F.col("p.indicator").alias("indicator"),
                       label(F.col("p.indicator")).alias("label"), F.col("p.value").alias("value")))


def status_board(latest_status: DataFrame) -> DataFrame:
    """Service status board (V14) from the latest value per (service, field):
    completed -> green, processing -> yellow, else red; title-cased label."""
    wide = latest_status.groupBy("service").agg(
        F.max(F.when(F.col("field") == "status", F.col("value"))).alias("status"),
        F.max(F.when(F.col("field") == "message", F.col("value"))).alias("message"))
    color = (F.when(F.col("status") == "completed", F.lit("green"))
              .when(F.col("status") == "processing", F.lit("yellow")).otherwise(F.lit("red")))
    return wide.select("service", label(F.col("service")).alias("label"),
                       with_default(F.col("status"), "Unknown").alias("status"),
                       "message", color.alias("color"))


def summary_steps(entries: DataFrame) -> DataFrame:
    """Summary drill-down (V15) from a run's file entries: one row per file step
    key/value, long form.

    File-level metrics come out as step ``file`` rows so that one table
    carries the whole expander content.
    """
    f = entries
    file_name = with_default(F.col("input_file"), "Unknown File").alias("input_file")
    metrics = f.select(file_name, F.lit("file").alias("step"), F.inline(F.array(
        F.struct(F.lit("original_rows").alias("key"), F.col("stats.original_rows").cast("string").alias("value")),
        F.struct(F.lit("final_rows").alias("key"), F.col("stats.final_rows").cast("string").alias("value")),
        F.struct(F.lit("data_quality_score").alias("key"),
                 F.col("stats.data_quality_score").cast("string").alias("value")))))
    st = f.select(file_name, F.explode("stats.steps").alias("s"))
    # the step log's list key is named after the step
    added_key = (F.when(F.col("s.step") == "technical_indicators", F.lit("indicators_added"))
                  .when(F.col("s.step") == "market_analysis", F.lit("analysis_added"))
                  .otherwise(F.lit("added")))
    kv = st.select("input_file", with_default(F.col("s.step"), "Unknown step").alias("step"), F.inline(F.array(
        F.struct(F.lit("rows_removed").alias("key"), F.col("s.rows_removed").cast("string").alias("value")),
        F.struct(F.lit("missing_before").alias("key"), F.col("s.missing_before").cast("string").alias("value")),
        F.struct(F.lit("missing_after").alias("key"), F.col("s.missing_after").cast("string").alias("value")),
        F.struct(added_key.alias("key"), F.array_join(F.col("s.added"), ",").alias("value")))))
    return metrics.unionByName(kv.where(F.col("value").isNotNull()))


def chart_series(df: DataFrame, key: str = "symbol", order: str = "date") -> DataFrame:
    """Long-form chart rows (V17, V19): (symbol, x, series, value), nulls dropped.
    Bars give candle OHLC, overlays, RSI, MACD and volume; quotes give
    ``current_price`` over time."""
    df = ensure_symbol(df) if key == "symbol" else df
    if "close" in df.columns:
        cols = [c for c in CHART_SERIES if c in df.columns]
        x = F.col(order).cast("timestamp")
    else:
        cols = ["current_price"]
        x = F.col("timestamp")
    base = df.select(F.col(key), x.alias("x"), *[F.col(c).cast("double") for c in cols])
    return (base.unpivot([key, "x"], cols, "series", "value")
                .where(F.col("value").isNotNull()))


def rsi_flags(df: DataFrame, hi: float = 70.0, lo: float = 30.0) -> DataFrame:
    """RSI guide lines as a flag: overbought / oversold / neutral."""
    flag = (F.when(F.col("rsi") >= hi, F.lit("overbought"))
             .when(F.col("rsi") <= lo, F.lit("oversold"))
             .when(F.col("rsi").isNotNull(), F.lit("neutral")))
    return df.withColumn("rsi_flag", flag)


def with_ordinal(df: DataFrame, keys: str | Sequence[str] = ("symbol",),
                 order: str | Sequence[str] = ("date",), out: str = "ordinal") -> DataFrame:
    """1-based row number per series as x-axis (P16), via the series index
    (no per-series window)."""
    return series_index(df, keys, order).withColumn(out, F.col(IDX) + 1).drop(IDX)
