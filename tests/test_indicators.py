"""Indicators against their definitions, edge series and the per-symbol property."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from marketframe.functions.scalar import nan_to_null
from marketframe.operators import indicators as I
from tests.goldens import definitions

COLS = I.INDICATOR_COLUMNS


def golden(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("date").reset_index(drop=True)
    return g.assign(**definitions(g["close"]))


def make_bars(series: dict[str, np.ndarray]) -> pd.DataFrame:
    rows = []
    d0 = dt.date(2020, 1, 1)
    for sym, closes in series.items():
        for i, c in enumerate(closes):
            rows.append((sym, d0 + dt.timedelta(days=i), float(c)))
    return pd.DataFrame(rows, columns=["symbol", "date", "close"])


def compare(spark, pdf, block=I.DEFAULT_BLOCK, tol=1e-8):
    out = I.indicators(spark.createDataFrame(pdf), block=block).toPandas()
    ref = pd.concat([golden(g) for _, g in pdf.groupby("symbol")])
    m = ref.merge(out, on=["symbol", "date"], suffixes=("_p", "_s"))
    assert len(m) == len(pdf) == len(out)
    for c in COLS:
        a, b = m[c + "_p"].astype(float), m[c + "_s"].astype(float)
        a = a.replace([np.inf, -np.inf], np.nan)
        assert (a.isna() == b.isna()).all(), c
        scale = np.maximum(1.0, np.abs(a.fillna(0)))
        assert (np.abs((a - b).fillna(0)) / scale).max() < tol, c


def test_random_walks_match_definitions(spark):
    rng = np.random.default_rng(7)
    series = {f"S{k}": 100 + np.cumsum(rng.normal(0, 1, n)) for k, n in enumerate([3, 25, 150, 400])}
    compare(spark, make_bars(series))


def test_many_blocks_match_definitions(spark):
    rng = np.random.default_rng(11)
    series = {"HOT": 50 + np.cumsum(rng.normal(0, 1, 3000)), "COLD": 10 + rng.random(40)}
    # smallest block the halo allows -> several blocks per long series
    compare(spark, make_bars(series), block=64)


def test_flat_rising_falling(spark):
    pdf = make_bars({"FLAT": np.full(25, 10.0), "UP": np.arange(1, 26, dtype=float),
                     "DOWN": np.arange(25, 0, -1, dtype=float)})
    out = I.indicators(spark.createDataFrame(pdf)).toPandas().sort_values(["symbol", "date"])
    last = out.groupby("symbol").tail(1).set_index("symbol")
    assert np.isnan(last.loc["FLAT", "rsi"])          # no gain, no loss
    assert last.loc["UP", "rsi"] == 100.0             # all gain
    assert last.loc["DOWN", "rsi"] == 0.0             # all loss
    assert last.loc["FLAT", "bb_upper"] == last.loc["FLAT", "bb_lower"] == 10.0


@pytest.mark.parametrize("n", [1, 5, 19, 20, 21])
def test_short_series_warmup(spark, n):
    pdf = make_bars({"A": np.linspace(1, 2, n)})
    out = I.indicators(spark.createDataFrame(pdf)).toPandas().sort_values("date").reset_index(drop=True)
    assert out["sma_5"].notna().sum() == max(0, n - 4)
    assert out["sma_20"].notna().sum() == max(0, n - 19)
    assert out["volatility"].notna().sum() == max(0, n - 20)   # first value at row 21
    assert out["ema_12"].notna().sum() == n                    # defined from row 1
    assert out["rsi"].notna().sum() == max(0, n - 13)          # row 14 already has a value


def test_symbols_do_not_leak(spark):
    rng = np.random.default_rng(3)
    a = make_bars({"A": 100 + np.cumsum(rng.normal(0, 1, 60))})
    b = make_bars({"B": 5 + np.cumsum(rng.normal(0, 1, 60))})
    alone = I.indicators(spark.createDataFrame(a)).toPandas().set_index("date").sort_index()
    both = I.indicators(spark.createDataFrame(pd.concat([a, b]))).toPandas()
    both = both[both.symbol == "A"].set_index("date").sort_index()
    pd.testing.assert_frame_equal(alone[COLS], both[COLS])


def test_input_order_does_not_matter(spark):
    rng = np.random.default_rng(5)
    pdf = make_bars({"A": 100 + np.cumsum(rng.normal(0, 1, 80)), "B": 50 + rng.random(80)})
    x = I.indicators(spark.createDataFrame(pdf)).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    shuffled = spark.createDataFrame(pdf.sample(frac=1.0, random_state=1)).repartition(7)
    y = I.indicators(shuffled).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(x, y)


def test_ewm_with_nulls_matches_pandas(spark):
    vals = [1.0, None, 3.0, None, None, 6.0, 2.0, None, 9.0, 4.0]
    pdf = make_bars({"A": np.array(vals, dtype=float)})
    out = I.ewm_mean(nan_to_null(spark.createDataFrame(pdf)), "close", 3).toPandas().sort_values("date")
    ref = pd.Series(vals, dtype=float).ewm(span=3).mean().to_numpy()
    assert np.allclose(out["ema_3"].to_numpy(), ref, rtol=1e-12, equal_nan=True)


def test_primitives(spark):
    pdf = make_bars({"A": np.array([1.0, 2.0, 4.0, 0.0, 5.0, 5.0])})
    df = spark.createDataFrame(pdf)
    d = I.diff(df).toPandas().sort_values("date")["close_diff"].tolist()
    assert np.isnan(d[0]) and d[1:] == [1.0, 2.0, -4.0, 5.0, 0.0]
    r = I.pct_change(df).toPandas().sort_values("date")["daily_return"].tolist()
    assert r[1] == 1.0 and r[3] == -1.0 and np.isnan(r[4])      # previous 0 -> null (pandas: inf)
    m = I.rolling_mean(df, "close", 3).toPandas().sort_values("date")["close_mean_3"].tolist()
    assert np.isnan(m[1]) and m[2] == pytest.approx(7 / 3)


def test_hot_series_with_ties_matches_pandas(spark):
    """One key holding every row, several rows per date: order by the tie
    columns; checked against the definitions over the same order."""
    rng = np.random.default_rng(9)
    n = 2500
    pdf = pd.DataFrame({"symbol": "ALL",
                        "date": [dt.date(2020, 1, 1) + dt.timedelta(days=int(i // 3)) for i in range(n)],
                        "k": rng.permutation(n), "close": 100 + np.cumsum(rng.normal(0, 1, n))})
    out = I.indicators(spark.createDataFrame(pdf), order=["date", "k"], block=900).toPandas()
    ref = golden(pdf.sort_values(["date", "k"]).rename(columns={"date": "d0"}).assign(date=lambda x: range(len(x))))
    ref = ref.sort_values("date").reset_index(drop=True)
    out = out.sort_values(["date", "k"]).reset_index(drop=True)
    for c in COLS:
        a, b = ref[c].astype(float).to_numpy(), out[c].astype(float).to_numpy()
        assert np.array_equal(np.isnan(a), np.isnan(b)), c
        assert np.nanmax(np.abs(a - b) / np.maximum(1, np.abs(np.nan_to_num(a)))) < 1e-8, c


@pytest.mark.parametrize("block", [1, 4000])
def test_ewm_carries_through_long_null_runs(spark, block):
    """A null run far longer than the halo: the last value stands, whatever the block."""
    rng = np.random.default_rng(2)
    vals = np.concatenate([50 + rng.random(100), np.full(3000, np.nan), 60 + rng.random(5)])
    df = nan_to_null(spark.createDataFrame(make_bars({"A": vals})))
    got = I.ewm_mean(df, "close", 12, block=block).toPandas().sort_values("date")["ema_12"].to_numpy(dtype=float)
    ref = pd.Series(vals).ewm(span=12).mean().to_numpy()
    assert np.allclose(got, ref, rtol=1e-9) and not np.isnan(got).any()
    macd = I.indicators(df, which=["macd", "macd_signal", "sma_5"], block=block).toPandas().sort_values("date")
    line = pd.Series(ref) - pd.Series(vals).ewm(span=26).mean()
    assert np.allclose(macd["macd"].to_numpy(dtype=float), line, rtol=1e-7, atol=1e-9)
    assert np.allclose(macd["macd_signal"].to_numpy(dtype=float), line.ewm(span=9).mean(), rtol=1e-7, atol=1e-9)
    assert macd["sma_5"].notna().sum() == 97
