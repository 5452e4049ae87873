"""Property tests: random series (skewed keys, nulls, block sizes) against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketframe.functions.scalar import nan_to_null
from tests.goldens import definitions
from marketframe.operators import clean as C
from marketframe.operators import indicators as I

D0 = dt.date(2021, 1, 1)

series_st = st.lists(
    st.tuples(st.sampled_from(["HOT", "HOT", "HOT", "A", "B"]),       # skewed keys
              st.one_of(st.none(), st.floats(1, 1000, allow_nan=False))),
    min_size=1, max_size=120)


def frame(rows):
    out, pos = [], {}
    for sym, v in rows:
        pos[sym] = pos.get(sym, -1) + 1
        out.append((sym, D0 + dt.timedelta(days=pos[sym]), v))
    return pd.DataFrame(out, columns=["symbol", "date", "close"])


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.too_slow])
@given(rows=series_st, block=st.integers(1, 9))
def test_fill_matches_pandas(spark, rows, block):
    pdf = frame(rows)
    df = nan_to_null(spark.createDataFrame(pdf, "symbol string, date date, close double"))
    got = C.fill_prices(df, ["close"], block=block).toPandas().sort_values(["symbol", "date"])
    exp = (pdf.sort_values(["symbol", "date"]).groupby("symbol", group_keys=False)["close"]
              .apply(lambda s: s.ffill().bfill()))
    assert np.allclose(got["close"].to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.too_slow])
@given(rows=st.lists(st.tuples(st.sampled_from(["HOT", "HOT", "A"]), st.floats(1, 1000, allow_nan=False)),
                     min_size=1, max_size=150), block=st.integers(21, 60))
def test_rolling_and_returns_match_definitions(spark, rows, block):
    pdf = frame(rows)
    which = ["sma_5", "sma_20", "rsi", "daily_return", "volatility"]
    got = I.indicators(spark.createDataFrame(pdf, "symbol string, date date, close double"),
                       which=which, block=block).toPandas().sort_values(["symbol", "date"])
    for sym, g in pdf.sort_values(["symbol", "date"]).groupby("symbol"):
        mine = got[got.symbol == sym].reset_index(drop=True)
        ref = definitions(g["close"])
        for k in which:
            a = ref[k]
            b = mine[k].to_numpy(dtype=float)
            assert np.array_equal(np.isnan(a), np.isnan(b)) or k == "rsi", k
            ok = ~np.isnan(a) & ~np.isnan(b)
            assert np.allclose(a[ok], b[ok], rtol=1e-7, atol=1e-7), k
