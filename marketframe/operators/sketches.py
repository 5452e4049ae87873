"""Medians from stored sketches (C04 for tables that grow by micro-batches).

The exact median of a batch ranks all its values, again whenever rows are added. A KLL sketch holds a
column in a few kilobytes, whatever the rows, and sketches merge: one per (batch, column, load) is
stored as rows arrive, and the median of a batch comes from its merged sketches without reading a
value again. With ``k`` items a level the rank of the returned value is off by at most about
``rank_error(k)`` of the rows (with 99 % probability), merged or not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import _wide
from .series import _cols

K = 400


def rank_error(k: int = K) -> float:
    """Normalized rank error of a KLL sketch (the fit that its authors' implementation documents)."""
    return 2.296 / k ** 0.9021


def value_sketches(df: DataFrame, cols: Sequence[str], batch: str | Sequence[str] = "batch_id", k: int = K) -> DataFrame:
    """(batch.., _mf_col, sketch, n): one sketch per batch and column over its values, nulls left out. A
    grouped aggregate whose map sides merge, so a batch of any size moves as one sketch a task."""
    batch = _cols(batch)
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("kv")
    long = df.select(*batch, kv).select(*batch, F.col("kv.c").alias("_mf_col"), F.col("kv.v").alias("_mf_v"))
    return long.where(F.col("_mf_v").isNotNull()).groupBy(*batch, "_mf_col").agg(
        F.kll_sketch_agg_double("_mf_v", k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, batch: str | Sequence[str] = "batch_id", k: int = K) -> DataFrame:
    """The sketches of several loads as one per batch and column."""
    batch = _cols(batch)
    return sketches.groupBy(*batch, "_mf_col").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketch_medians(sketches: DataFrame, cols: Sequence[str], batch: str | Sequence[str] = "batch_id") -> DataFrame:
    """One row per batch with the median of each column; null where it has no value."""
    batch = _cols(batch)
    med = sketches.select(*batch, "_mf_col", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("_mf_med"))
    return _wide(med, cols, batch)


def fill_from_sketches(df: DataFrame, sketches: DataFrame, cols: Sequence[str],
                       batch: str | Sequence[str] = "batch_id") -> DataFrame:
    """Nulls of ``cols`` filled with their batch's median from stored sketches; filled columns are doubles."""
    batch = _cols(batch)
    med = sketch_medians(sketches, cols, batch).select(
        *[F.col(b).alias(f"_mf_k{j}") for j, b in enumerate(batch)], *[F.col(c).alias(f"_mf_m_{c}") for c in cols])
    on = F.lit(True)
    for j, b in enumerate(batch):
        on = on & df[b].eqNullSafe(F.col(f"_mf_k{j}"))
    return df.join(med, on, "left").select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_mf_m_{c}")).alias(c)
                                             if c in cols else F.col(c) for c in df.columns])
