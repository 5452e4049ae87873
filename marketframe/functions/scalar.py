"""Scalar helpers (P01-P17). All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["nan_to_null", "round_half_even", "project_available", "for_symbol", "clip_sign", "round_numeric", "label",
           "format_metrics", "epoch_to_ts", "epoch_to_date", "with_default", "ensure_symbol",
           "parse_symbols", "date_window"]


def project_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order.
    Resolved at plan time; no data is read."""
    return df.select(*[c for c in wanted if c in df.columns])


def for_symbol(df: DataFrame, symbol: str, col: str = "symbol") -> DataFrame:
    """Equality filter by symbol (P03); pushed to the Parquet scan."""
    return df.where(F.col(col) == F.lit(symbol))


def clip_sign(c: Column, sign: int = 1) -> Column:
    """Keep positive (sign=1) or negative (sign=-1, negated) part, else 0."""
    return (F.when(c > 0, c) if sign > 0 else F.when(c < 0, -c)).otherwise(F.lit(0.0))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN doubles -> null, so that Spark's null means pandas' missing value
    (the source boundary rule: every operator treats null as missing)."""
    frac = (T.DoubleType, T.FloatType)
    return df.select(*[F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
                       if isinstance(f.dataType, frac) else F.col(f.name) for f in df.schema.fields])


def round_half_even(c: Column, n: int = 2) -> Column:
    """pandas/numpy rounding: ``rint(x * 10^n) / 10^n`` on the binary value
    (ties to even). Spark's ``round`` rounds the decimal text half-up and
    differs on values such as 10083.845."""
    scale = float(10 ** n)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round_numeric(df: DataFrame, n: int = 2) -> DataFrame:
    """Round every fractional numeric column to ``n`` places as pandas'
    ``DataFrame.round`` does (P06, V12)."""
    frac = (T.DoubleType, T.FloatType)
    return df.select(*[round_half_even(F.col(f.name), n).alias(f.name) if isinstance(f.dataType, frac)
                       else F.col(f.name) for f in df.schema.fields])


def label(c: Column) -> Column:
    """``a_b`` -> ``A B``."""
    return F.initcap(F.regexp_replace(c, "_", " "))


def format_metrics(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add display strings: ``spec`` maps column -> ``money`` | ``percent`` |
    ``thousands`` | ``fixed2`` | ``fixed1`` (P08). Adds ``<col>_fmt``."""
    fmt = {
        "money": lambda c: F.format_string("$%.2f", c),
        "percent": lambda c: F.format_string("%.2f%%", c),
        "thousands": lambda c: F.format_number(c, 0),
        "fixed2": lambda c: F.format_string("%.2f", c),
        "fixed1": lambda c: F.format_string("%.1f", c),
    }
    # a null value stays null (format_string would print "null")
    return df.select("*", *[F.when(F.col(c).isNotNull(), fmt[k](F.col(c))).alias(f"{c}_fmt")
                            for c, k in spec.items()])


def epoch_to_ts(c: Column, zero_is_null: bool = True) -> Column:
    """Epoch seconds -> timestamp; 0 or null -> null (P09, news datetime)."""
    c = c.cast("bigint")
    return F.when(c.isNotNull() & (c != 0), F.timestamp_seconds(c)) if zero_is_null else F.timestamp_seconds(c)


def epoch_to_date(c: Column) -> Column:
    """Epoch seconds -> UTC date (P09, candle dates)."""
    return F.to_date(F.timestamp_seconds(c.cast("bigint")))


def with_default(c: Column, value) -> Column:
    """Default for a missing value."""
    return F.coalesce(c, F.lit(value))


def ensure_symbol(df: DataFrame, default: str = "Stock") -> DataFrame:
    """A table without ``symbol`` is one series named ``Stock``."""
    return df if "symbol" in df.columns else df.withColumn("symbol", F.lit(default))


def parse_symbols(c: Column) -> Column:
    """Comma list -> array of trimmed symbols."""
    return F.transform(F.split(c, ","), lambda s: F.trim(s))


def date_window(df: DataFrame, col: str, days_back: int = 0, days_ahead: int = 0,
                as_of=None) -> DataFrame:
    """Keep rows whose ``col`` date lies in [as_of - back, as_of + ahead].

    ``as_of`` is a parameter (a date literal or column), never the wall clock,
    so reruns are reproducible. A plain range predicate: Parquet pushes it down.
    """
    ref = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column)
                                                  else F.lit(as_of).cast("date"))
    d = F.col(col).cast("date")
    return df.where(d.between(F.date_sub(ref, days_back), F.date_add(ref, days_ahead)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: bound as a lambda variable, where a
    plain reference is evaluated again in every use."""
    return F.transform(F.array(value), body)[0]
