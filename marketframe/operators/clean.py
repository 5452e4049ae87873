"""Cleaning of one batch (file) of quotes or bars: duplicates, gap fills,
median fills, missing-cell counts and the data-quality score (C01-C10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import round_half_even
from ..session import materialize
from .series import BLK, DEFAULT_BLOCK, IDX, OWN, _cols, fill_indexed, series_index, with_blocks

# The price columns the reference fills forward then backward.
PRICE_COLUMNS = ["current_price", "high_price", "low_price", "open_price",
                 "close", "high", "low", "open"]

# Items a level of the sketches that enclose a median, and how far from it in rank the two values
# are taken: three times ``sketches.rank_error(MEDIAN_K)``.
MEDIAN_K, MEDIAN_SLACK = 800, 0.0165


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows over all columns, keep one.

    ``dropDuplicates`` plans a partial (map-side) aggregate before the
    shuffle, so many copies of one row are collapsed before they move.
    """
    return df.dropDuplicates()


def fill_prices(df: DataFrame, cols: Sequence[str] | None = None,
                keys: str | Sequence[str] = ("symbol",), order: str | Sequence[str] = ("date",),
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Forward then backward fill of price columns per series.

    Per symbol in date order (the reference filled in file order across
    symbols). Unbounded frames run blocked: see ``series.fill_indexed``.
    """
    keys, order = _cols(keys), _cols(order)
    cols = [c for c in (PRICE_COLUMNS if cols is None else cols) if c in df.columns]
    if not cols:
        return df
    t = with_blocks(series_index(df, keys, order), block, 0)
    return fill_indexed(t, cols, keys).drop(IDX, BLK, OWN)


def _median_bounds(df: DataFrame, cols: Sequence[str], batch: list[str], only_gaps: bool) -> DataFrame:
    """(_mf_k.., a struct per column): whether its median is wanted, the 0-based ranks of the one or two middle
    values, and two values that should enclose them, taken from a sketch a batch and column."""
    aggs, out = [], []
    for j, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.kll_sketch_agg_double(v, MEDIAN_K).alias(f"s{j}"), F.count(v).alias(f"n{j}"),
                 F.count(F.when(~F.isnan(v), v)).alias(f"r{j}"), F.max(F.col(c).isNull()).alias(f"g{j}")]
        some, n = F.col(f"r{j}") > 0, F.col(f"n{j}")    # a sketch leaves NaN out
        out.append(F.struct(
            (F.col(f"g{j}") if only_gaps else F.lit(True)).alias("want"),
            F.floor((n - 1) / 2).alias("at"), F.floor(n / 2).alias("to"),
            *[F.when(some, F.kll_sketch_get_quantile_double(f"s{j}", F.lit(q))).alias(a)
              for a, q in (("lo", 0.5 - MEDIAN_SLACK), ("hi", 0.5 + MEDIAN_SLACK))]).alias(f"_mf_b{j}"))
    return df.groupBy(*[F.col(b).alias(f"_mf_k{j}") for j, b in enumerate(batch)]).agg(*aggs).select(
        *[f"_mf_k{j}" for j in range(len(batch))], *out)


def _medians_long(df: DataFrame, cols: Sequence[str], batch: list[str], only_gaps: bool = False,
                  stored: bool = False) -> DataFrame:
    """(batch..., _mf_col, _mf_med): exact median of every column per batch.

    A sketch gives two values around the middle of every batch and column, a count how many values lie
    below and between them. Only the few between are unpivoted to ``(batch, col, v)`` and ranked by
    the series index (a range-partitioned sort, so a huge batch is split over
    many tasks); the one or two middle ranks are averaged - pandas' median. Where the count
    shows that the middle lies elsewhere, all values are ranked, so a sketch decides how
    much is sorted but never the result. ``only_gaps`` leaves out the
    columns of batches without a null, which need no median to be filled. The values are
    read several times: from a copy, unless ``df`` is ``stored``.
    """
    if not stored:
        df = materialize(df.select(*batch, *cols), "median-values")
    bounds = materialize(_median_bounds(df, cols, batch, only_gaps), "median-bounds")
    on = lambda t: [df[b].eqNullSafe(t[f"_mf_k{j}"]) for j, b in enumerate(batch)]
    keys = [f"_mf_k{j}" for j in range(len(batch))]
    value = [F.col(c).cast("double") for c in cols]
    bound = [F.col(f"_mf_b{j}") for j in range(len(cols))]
    below = [(v < b["lo"]) for v, b in zip(value, bound)]
    between = [v.between(b["lo"], b["hi"]) for v, b in zip(value, bound)]
    counts = df.join(bounds, on(bounds)).groupBy(*[F.col(k).alias(f"_mf_c{j}") for j, k in enumerate(keys)]).agg(
        *[F.count_if(x).alias(f"_mf_lt{j}") for j, x in enumerate(below)],
        *[F.count_if(x).alias(f"_mf_in{j}") for j, x in enumerate(between)])
    found = [(F.col(f"_mf_lt{j}") <= b["at"]) & (b["to"] < F.col(f"_mf_lt{j}") + F.col(f"_mf_in{j}")) for j, b in enumerate(bound)]
    narrow = materialize(counts.join(bounds, [F.col(f"_mf_c{j}").eqNullSafe(F.col(k)) for j, k in enumerate(keys)]).select(*keys, *[
        b.withField("all", ~ok).withField("skip", F.when(ok, F.col(f"_mf_lt{j}")).otherwise(0)).alias(f"_mf_b{j}")
        for j, (b, ok) in enumerate(zip(bound, found))]), "median-counts")
    kv = F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.when(b["want"] & (b["all"] | near), v).alias("v"),
                 (b["at"] - b["skip"]).alias("at"), (b["to"] - b["skip"]).alias("to"))
        for c, v, b, near in zip(cols, value, bound, between)])).alias("kv")
    long = df.join(narrow, on(narrow)).select(*[df[b] for b in batch], kv).where(F.col("kv.v").isNotNull()).select(
        *batch, F.col("kv.k").alias("_mf_col"), F.col("kv.v").alias("_mf_v"), F.col("kv.at").alias("_mf_at"), F.col("kv.to").alias("_mf_to"))
    keys = [*batch, "_mf_col"]
    ranked = series_index(long, keys, ["_mf_v"], tiebreak=[])
    mid = ranked.where((F.col(IDX) == F.col("_mf_at")) | (F.col(IDX) == F.col("_mf_to")))
    return mid.groupBy(*keys).agg(F.avg("_mf_v").alias("_mf_med"))


def _wide(med_long: DataFrame, cols: Sequence[str], batch: list[str]) -> DataFrame:
    return med_long.groupBy(*batch).agg(*[F.max(F.when(F.col("_mf_col") == c, F.col("_mf_med"))).alias(c)
                                          for c in cols])


def batch_medians(df: DataFrame, cols: Sequence[str], batch: str | Sequence[str] = "batch_id",
                  approx: bool = False) -> DataFrame:
    """One row per batch with the median of each column (nulls skipped).

    Exact by default and distributed (see ``_medians_long``); ``approx=True``
    uses ``percentile_approx`` instead (one bounded sketch per batch and
    column). A batch whose column is all null gets null.
    """
    batch = _cols(batch)
    if not cols:
        return df.select(*batch).distinct()
    if approx:
        return df.groupBy(*batch).agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c)
                                        for c in cols])
    present = df.select(*batch).distinct()
    return present.join(_wide(_medians_long(df, cols, batch), cols, batch), batch, "left")


def fill_median(df: DataFrame, cols: Sequence[str] | None = None,
                batch: str | Sequence[str] = "batch_id", approx: bool = False, stored: bool = False) -> DataFrame:
    """Fill nulls with the batch median, for every numeric column that is not a
    price column (volume and the rest, C04). An all-null column stays null. Filled
    columns are doubles, as the median of an even number of integers may be a half.
    Exact medians are taken only where a batch has a null in the column. ``stored``: the
    rows lie in a table, which is read again instead of copied."""
    batch = _cols(batch)
    if cols is None:
        cols = [c for c in numeric_columns(df, exclude=batch) if c not in PRICE_COLUMNS]
    cols = list(cols)
    if not cols:
        return df
    if approx:
        wide = batch_medians(df, cols, batch, approx=True)
    else:
        wide = _wide(_medians_long(df, cols, batch, only_gaps=True, stored=stored), cols, batch)
    med = wide.select(*batch, *[F.col(c).alias(f"_mf_m_{c}") for c in cols])
    j = df.join(med, batch, "left")
    return j.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_mf_m_{c}")).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def null_count(cols: Sequence[str]) -> Column:
    """Number of null cells among ``cols`` in the row."""
    if not cols:
        return F.lit(0).cast("bigint")
    return sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))


def missing_cells(df: DataFrame, batch: str | Sequence[str] = "batch_id",
                  cols: Sequence[str] | None = None) -> DataFrame:
    """Missing numeric cells per batch."""
    batch = _cols(batch)
    cols = numeric_columns(df, exclude=batch) if cols is None else list(cols)
    return df.groupBy(*batch).agg(F.sum(null_count(cols)).alias("missing_cells"),
                                  F.count(F.lit(1)).alias("rows"))


def quality_score(df: DataFrame, batch: str | Sequence[str] = "batch_id",
                  cols: Sequence[str] | None = None) -> DataFrame:
    """round(100 * (1 - nulls / (rows * columns)), 2) per batch over all
    output columns, indicator warm-up nulls included (C07)."""
    batch = _cols(batch)
    cols = [c for c in df.columns if c not in batch] if cols is None else list(cols)
    agg = df.groupBy(*batch).agg(F.count(F.lit(1)).alias("final_rows"),
                                 F.sum(null_count(cols)).alias("_mf_nulls"))
    comp = F.lit(1.0) - F.try_divide(F.col("_mf_nulls").cast("double"),
                                     (F.col("final_rows") * len(cols)).cast("double"))
    return agg.select(*batch, "final_rows", round_half_even(comp * 100, 2).alias("data_quality_score"))


def min_rows_gate(df: DataFrame, keys: str | Sequence[str] = ("symbol",), min_rows: int = 20,
                  out: str = "indicators_ok") -> DataFrame:
    """Flag series with more than ``min_rows`` rows (C10's row gate).

    A grouped count joined back (partial aggregation; no per-series window).
    """
    keys = _cols(keys)
    n = df.groupBy(*[F.col(k).alias(f"_mf_k{j}") for j, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_mf_rows"))
    cond = [df[k].eqNullSafe(n[f"_mf_k{j}"]) for j, k in enumerate(keys)]
    return (df.join(n, cond, "left")
              .select(*[df[c] for c in df.columns], (F.col("_mf_rows") > min_rows).alias(out)))
