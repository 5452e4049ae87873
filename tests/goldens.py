"""Indicator values straight from their definitions, one row at a time in NumPy."""

from __future__ import annotations

import math

import numpy as np

NAN = float("nan")


def last(x, i: int, n: int):
    """The ``n`` values that end at row ``i``, or None before there are so many."""
    return None if i + 1 < n else np.asarray(x[i + 1 - n:i + 1], dtype=float)


def mean(x, i: int, n: int) -> float:
    w = last(x, i, n)
    return NAN if w is None or np.isnan(w).any() else math.fsum(w) / n


def spread(x, i: int, n: int) -> float:
    """Sample standard deviation of the last ``n`` values."""
    w = last(x, i, n)
    if w is None or np.isnan(w).any():
        return NAN
    m = math.fsum(w) / n
    return math.sqrt(math.fsum((v - m) ** 2 for v in w) / (n - 1))


def weighted(x, i: int, span: float) -> float:
    """Exponentially weighted mean of rows 0..i: weight (1 - 2/(span+1)) ** age, missing
    rows have no weight but age the others; after a missing row the last value stands."""
    x = np.asarray(x[:i + 1], dtype=float)
    seen = np.flatnonzero(~np.isnan(x))
    if not len(seen):
        return NAN
    i = int(seen[-1])
    weights = (1.0 - 2.0 / (span + 1.0)) ** (i - seen)
    return float((weights * x[seen]).sum() / weights.sum())


def strength(x, i: int, n: int = 14) -> float:
    """100 * ups / (ups + downs) over the last ``n`` moves; the first row does not move."""
    if i + 1 < n:
        return NAN
    moves = [0.0 if k == 0 else x[k] - x[k - 1] for k in range(i + 1 - n, i + 1)]
    up, down = math.fsum(m for m in moves if m > 0), math.fsum(-m for m in moves if m < 0)
    return NAN if up + down == 0 else 100.0 * up / (up + down)


def change(x, i: int) -> float:
    return NAN if i == 0 or x[i - 1] == 0 else x[i] / x[i - 1] - 1.0


def definitions(closes) -> dict[str, np.ndarray]:
    x, rows = [float(v) for v in closes], range(len(closes))
    out = {f"sma_{n}": [mean(x, i, n) for i in rows] for n in (5, 20)}
    out |= {f"ema_{n}": [weighted(x, i, n) for i in rows] for n in (12, 26)}
    out["macd"] = [a - b for a, b in zip(out["ema_12"], out["ema_26"])]
    out["macd_signal"] = [weighted(out["macd"], i, 9) for i in rows]
    out["macd_histogram"] = [a - b for a, b in zip(out["macd"], out["macd_signal"])]
    out["rsi"] = [strength(x, i) for i in rows]
    band = [spread(x, i, 20) for i in rows]
    out["bb_middle"] = out["sma_20"]
    out["bb_upper"] = [m + 2 * s for m, s in zip(out["sma_20"], band)]
    out["bb_lower"] = [m - 2 * s for m, s in zip(out["sma_20"], band)]
    out["daily_return"] = [change(x, i) for i in rows]
    out["volatility"] = [spread(out["daily_return"], i, 20) for i in rows]
    return {k: np.array(v, dtype=float) for k, v in out.items()}
