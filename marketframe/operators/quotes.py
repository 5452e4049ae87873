"""Quote analysis: recomputed change percent and market sentiment (Q01, Q02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentiment labels of the reference, strongest up to strongest down.
STRONG_BULLISH, BULLISH, BEARISH, STRONG_BEARISH = (
    "Strong Bullish", "Bullish", "Bearish", "Strong Bearish")


def pct(a: Column, b: Column) -> Column:
    """(a - b) / b * 100; null when either is null or b is 0."""
    return F.try_divide(a - b, b) * F.lit(100.0)


def sentiment_of(change_pct: Column, strong: float = 2.0) -> Column:
    """> strong: Strong Bullish; > 0: Bullish; > -strong: Bearish (0 is
    Bearish); else Strong Bearish (-strong included); null -> null."""
    return (F.when(change_pct > strong, F.lit(STRONG_BULLISH))
             .when(change_pct > 0, F.lit(BULLISH))
             .when(change_pct > -strong, F.lit(BEARISH))
             .when(change_pct.isNotNull(), F.lit(STRONG_BEARISH)))


def quote_change(df: DataFrame) -> DataFrame:
    """Add ``change_percent_calc`` from current_price and previous_close (Q01)."""
    return df.withColumn("change_percent_calc", pct(F.col("current_price"), F.col("previous_close")))


def quote_sentiment(df: DataFrame, strong: float = 2.0) -> DataFrame:
    """Add ``change_percent_calc`` and ``sentiment`` (Q01 + Q02)."""
    if "change_percent_calc" not in df.columns:
        df = quote_change(df)
    return df.withColumn("sentiment", sentiment_of(F.col("change_percent_calc"), strong))
