"""Cleaning jobs and their reports: the per-batch step log (C06), quality
score (C07), run summary (C08), failure isolation (C09) and kind switch (C10).

``clean_bars`` / ``clean_quotes`` process any number of batches in one plan:
a batch is a value of ``batch_id``, not a loop iteration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null, round_half_even
from .clean import PRICE_COLUMNS, dedup_rows, fill_median, min_rows_gate, null_count, numeric_columns
from .indicators import indicators_indexed
from .quotes import quote_sentiment
from ..session import materialize
from .series import BLK, DEFAULT_BLOCK, IDX, OWN, fill_indexed, fill_series, series_index, with_blocks

# Step names and the lists the reference writes into its step log.
STEP_DEDUP = "remove_duplicates"
STEP_MISSING = "handle_missing_values"
STEP_INDICATORS = "technical_indicators"
STEP_ANALYSIS = "market_analysis"
INDICATORS_ADDED = ["sma_5", "sma_20", "ema_12", "ema_26", "macd", "rsi", "bollinger_bands", "volatility"]
ANALYSIS_ADDED = ["change_percent_calc", "sentiment"]

STEP_TYPE = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("rows_removed", T.LongType()),
    T.StructField("missing_before", T.LongType()),
    T.StructField("missing_after", T.LongType()),
    T.StructField("added", T.ArrayType(T.StringType())),
])


def clean_bars(raw: DataFrame, batch: str = "batch_id", keys: Sequence[str] = ("symbol",),
               order: Sequence[str] = ("date",), min_rows: int | None = None,
               block: int = DEFAULT_BLOCK, approx_median: bool = False,
               cut_lineage: bool = True) -> DataFrame:
    """Bars batch job: dedup -> price fill -> median fill -> indicators.

    Series are ``(batch, *keys)`` in ``order``. One series index serves the
    price fill and all indicators. Warm-up rows have null indicators, which needs
    no row gate; with ``min_rows`` all indicators of a batch (file) with that many
    rows or fewer are null (the columns always exist). With ``cut_lineage`` the
    cleaned stage is written to the shared checkpoint folder (one job) and
    the indicators start from that table.
    """
    series = [batch, *keys] if batch in raw.columns else list(keys)
    d = dedup_rows(nan_to_null(raw))
    prices = [c for c in PRICE_COLUMNS if c in d.columns]
    others = [c for c in numeric_columns(d, exclude=[batch, *keys]) if c not in PRICE_COLUMNS]
    idx = series_index(d, series, order)
    t = fill_indexed(with_blocks(idx, block, 0), prices, series).drop(BLK, OWN)
    if cut_lineage:
        t = materialize(t, "clean-bars")
    if batch in t.columns:
        t = fill_median(t, others, batch=batch, approx=approx_median, stored=cut_lineage)
    gate = None
    if min_rows is not None:
        gate, t = "_mf_gate", min_rows_gate(t, [batch] if batch in t.columns else list(keys), min_rows, "_mf_gate")
    return indicators_indexed(t, "close", series, block, gate=gate).drop(IDX, "_mf_gate")


def clean_quotes(raw: DataFrame, batch: str = "batch_id", keys: Sequence[str] = ("symbol",),
                 order: Sequence[str] = ("timestamp",), strong: float = 2.0,
                 block: int = DEFAULT_BLOCK, approx_median: bool = False,
                 cut_lineage: bool = True) -> DataFrame:
    """Quotes batch job: dedup -> price fill per batch (file) and symbol by time
    -> median fill per batch -> change percent and sentiment. A batch's result
    depends on that batch only, so batch runs, reruns and streams agree whatever
    runs together. With ``cut_lineage`` the filled stage is written to the shared
    checkpoint folder once and the median fill reads it."""
    rows = nan_to_null(raw)
    d = dedup_rows(rows)
    series = [batch, *keys] if batch in d.columns else list(keys)
    prices = [c for c in PRICE_COLUMNS if c in d.columns]
    others = [c for c in numeric_columns(d, exclude=[batch, *keys]) if c not in PRICE_COLUMNS]
    t = fill_series(d, prices, series, list(order), block, counted=rows)
    if cut_lineage:
        t = materialize(t, "clean-quotes")
    if batch in t.columns:
        t = fill_median(t, others, batch=batch, approx=approx_median, stored=cut_lineage)
    return quote_sentiment(t, strong)


def _step(name, removed=None, before=None, after=None, added=None):
    return F.struct(F.lit(name).alias("step"),
                    (removed if removed is not None else F.lit(None)).cast("bigint").alias("rows_removed"),
                    (before if before is not None else F.lit(None)).cast("bigint").alias("missing_before"),
                    (after if after is not None else F.lit(None)).cast("bigint").alias("missing_after"),
                    (F.array(*[F.lit(x) for x in added]) if added else F.lit(None)).cast("array<string>")
                    .alias("added"))


def cleaning_report(raw: DataFrame, processed: DataFrame, kind: str, batch: str = "batch_id",
                    min_rows: int | None = None) -> DataFrame:
    """One row per batch: original/final rows, quality score and the steps
    that acted (C06): duplicates removed, missing values before/after the
    fills, indicators added, analysis added.

    ``kind`` is ``historical`` (bars) or ``quotes``. Every count is a grouped
    aggregate per batch; the inputs are whole tables. NaN counts as missing, as it
    does in the fills. One grouped count over all columns gives the rows of each
    batch before and after duplicates go. ``min_rows`` is that of ``clean_bars``.
    """
    num_in = numeric_columns(raw, exclude=[batch])
    rows = nan_to_null(raw).groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_mf_copies"))
    dd = rows.groupBy(batch).agg(F.sum("_mf_copies").alias("original_rows"),
                                 F.count(F.lit(1)).alias("_mf_dedup_rows"),
                                 F.sum(null_count(num_in)).alias("_mf_miss_before"))
    out_cols = [c for c in processed.columns if c != batch]
    fin = processed.groupBy(batch).agg(
        F.count(F.lit(1)).alias("final_rows"),
        F.sum(null_count(num_in)).alias("_mf_miss_after"),
        F.sum(null_count(out_cols)).alias("_mf_nulls"))
    r = dd.join(fin, batch, "left")
    removed = F.col("original_rows") - F.col("_mf_dedup_rows")
    steps = [
        F.when(removed != 0, _step(STEP_DEDUP, removed=removed)),
        F.when(F.col("_mf_miss_before") > 0,
               _step(STEP_MISSING, before=F.col("_mf_miss_before"), after=F.col("_mf_miss_after"))),
    ]
    if kind == "historical" and "close" in processed.columns:
        acted = F.lit(True) if min_rows is None else F.col("final_rows") > min_rows
        steps.append(F.when(acted, _step(STEP_INDICATORS, added=INDICATORS_ADDED)))
    if kind == "quotes" and "current_price" in processed.columns:
        steps.append(_step(STEP_ANALYSIS, added=ANALYSIS_ADDED))
    comp = F.lit(1.0) - F.try_divide(F.col("_mf_nulls").cast("double"),
                                     (F.col("final_rows") * len(out_cols)).cast("double"))
    return r.select(
        F.col(batch), F.lit(kind).alias("file_type"),
        F.col("original_rows"), F.col("final_rows"),
        round_half_even(comp * 100, 2).alias("data_quality_score"),
        F.filter(F.array(*steps).cast(T.ArrayType(STEP_TYPE)), lambda s: s.isNotNull()).alias("steps"))


def file_entries(report: DataFrame, run_id: str, batch: str = "batch_id") -> DataFrame:
    """The file entries of a run (C08), one row per file: run_id, input_file,
    file_type and stats. A table of its own, as a run may have any number of files."""
    return report.select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.when(F.col("file_type") == "quotes", F.lit("stock_quotes_"))
                  .otherwise(F.lit("stock_historical_")), F.col(batch), F.lit(".csv")).alias("input_file"),
        F.col("file_type"),
        F.struct("original_rows", "final_rows", "data_quality_score", "steps", "file_type").alias("stats"))


def run_summary(report: DataFrame, run_id: str, run_ts=None) -> DataFrame:
    """The totals of a run (C08), one row: run_id, timestamp, file count and the
    average of the per-file scores rounded to 2 places. Its files are the rows of
    ``file_entries`` with the same run_id."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return report.agg(
        F.lit(run_id).alias("run_id"), ts.alias("timestamp"),
        F.count(F.lit(1)).alias("total_files_processed"),
        round_half_even(F.avg("data_quality_score"), 2).alias("average_quality_score"))


def latest_summary(summaries: DataFrame, entries: DataFrame) -> DataFrame:
    """The newest run's file entries with the run's totals; newest by
    (timestamp, run_id), found by one grouped maximum."""
    newest = summaries.agg(F.max(F.struct("timestamp", "run_id", "total_files_processed",
                                          "average_quality_score")).alias("s")).select("s.*")
    return entries.join(newest, "run_id")
