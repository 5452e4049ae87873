"""Change percent and sentiment thresholds (Q01, Q02)."""

import pytest

from marketframe.operators.quotes import quote_sentiment


@pytest.mark.parametrize("cur,prev,label", [
    (98.0, 100.0, "Strong Bearish"),       # exactly -2 -> Strong Bearish
    (98.0000001, 100.0, "Bearish"),        # just above -2
    (100.0, 100.0, "Bearish"),             # 0 -> Bearish
    (100.0000001, 100.0, "Bullish"),
    (102.0, 100.0, "Bullish"),             # exactly 2 -> Bullish
    (102.0000001, 100.0, "Strong Bullish"),
    (None, 100.0, None),
    (5.0, 0.0, None),                      # previous close 0 -> null (reference: error)
])
def test_thresholds(spark, cur, prev, label):
    df = spark.createDataFrame([("X", cur, prev)], "symbol string, current_price double, previous_close double")
    r = quote_sentiment(df).first()
    assert r.sentiment == label
    if label is not None:
        assert r.change_percent_calc == pytest.approx((cur - prev) / prev * 100)
