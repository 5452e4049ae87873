"""Technical indicators per series (SMA, EMA, MACD, RSI, Bollinger, returns, volatility).

Semantics are those of pandas ``rolling``/``ewm``/``diff``/``pct_change`` on
one symbol's series sorted by date, evaluated per symbol (the reference ran
them over a whole multi-symbol file; see README "Deviations").
All indicators come from one series index and one blocked window pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_sign
from .series import (BLK, DEFAULT_BLOCK, IDX, OWN, _cols, diff_col, ewm_block_limit, ewm_carried, ewm_col,
                     ewm_halo, pct_change_col, rolling_mean_col, rolling_std_col,
                     series_index, with_blocks)

# The 13 indicator columns of the reference's cleaning job, in its order.
INDICATOR_COLUMNS = ["sma_5", "sma_20", "ema_12", "ema_26", "macd", "macd_signal",
                     "macd_histogram", "rsi", "bb_middle", "bb_upper", "bb_lower",
                     "daily_return", "volatility"]


def rsi_col(gain_mean, loss_mean):
    """100 - 100/(1+gain/loss); all-gain frame -> 100; flat frame -> null."""
    return (F.when(loss_mean == 0, F.when(gain_mean > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(gain_mean, loss_mean))))


def indicators_indexed(idx: DataFrame, price: str = "close", keys: Sequence[str] = ("symbol",),
                       block: int = DEFAULT_BLOCK, sma: Sequence[int] = (5, 20),
                       ema: Sequence[int] = (12, 26), signal: int = 9, rsi_n: int = 14,
                       bb_n: int = 20, bb_k: float = 2.0, vol_n: int = 20,
                       gate: str | None = None, which: Sequence[str] | None = None) -> DataFrame:
    """Indicators on a frame that already carries ``_mf_i`` (see ``series_index``).

    ``which``: subset of indicator names to compute (default all 13).
    ``gate``: optional boolean column; where false all indicators are null
    (the reference's "more than 20 rows" rule, C10).
    """
    keys = list(keys)
    e1, e2 = ema[0], ema[1]
    sma_names = [f"sma_{n}" for n in sma]
    ema_names = [f"ema_{e}" for e in ema]
    names = (sma_names + ema_names + ["macd", "macd_signal", "macd_histogram", "rsi", "bb_middle",
                                      "bb_upper", "bb_lower", "daily_return", "volatility"])
    want = set(names if which is None else which)
    need_ewm = bool(want & {*ema_names, "macd", "macd_signal", "macd_histogram"})
    need_signal = bool(want & {"macd_signal", "macd_histogram"})
    if need_ewm and _has_nulls(idx, price):
        return _with_carried_ewm(idx, price, keys, block, ema, signal, names, want, need_signal, gate,
                                 sma=sma, rsi_n=rsi_n, bb_n=bb_n, bb_k=bb_k, vol_n=vol_n)
    lookbacks = [1]
    lookbacks += [n - 1 for n, nm in zip(sma, sma_names) if nm in want]
    lookbacks += [rsi_n] if "rsi" in want else []
    lookbacks += [bb_n - 1] if want & {"bb_middle", "bb_upper", "bb_lower"} else []
    lookbacks += [vol_n] if "volatility" in want else []
    reach = max(lookbacks)
    spans = []
    if need_ewm:
        spans = list(ema)
        lookbacks += [ewm_halo(e) for e in ema]
        if need_signal:
            spans.append(signal)
            lookbacks.append(max(ewm_halo(e) for e in ema) + ewm_halo(signal))
    halo = max(lookbacks)
    limit = min([ewm_block_limit(s_) for s_ in spans], default=1 << 30)
    if halo > limit:
        raise ValueError(f"EWM halo {halo} exceeds the exponent limit {limit}; use larger spans")
    B = max(min(block, limit), halo + 1)
    c = F.col(price)
    t = with_blocks(idx, B, halo)
    # pass 1: lags and EMAs; pass 2: MACD signal; pass 3: rolling frames, each taken once, over
    # the few halo rows that they reach (the EWM halo is far longer). One partitioning and
    # order for all: a single exchange and sort.
    first = {}
    if want & {"daily_return", "volatility"}:
        first["daily_return"] = pct_change_col(c, keys)
    if "rsi" in want:
        first["_mf_delta"] = diff_col(c, keys)
    if need_ewm:
        for e in ema:
            first[f"ema_{e}"] = ewm_col(c, e, keys, B)
    t = t.select("*", *[v.alias(k) for k, v in first.items()])
    if need_ewm:
        t = t.withColumn("macd", F.col(f"ema_{e1}") - F.col(f"ema_{e2}"))
    if need_signal:
        t = t.withColumn("macd_signal", ewm_col(F.col("macd"), signal, keys, B))
    if halo > reach:
        t = t.where(F.col(IDX) >= F.col(BLK) * B - reach)
    means = {f"_mf_mean_{n}": (c, n) for n, nm in zip(sma, sma_names) if nm in want}
    if "rsi" in want:
        means["_mf_gain"] = (clip_sign(F.col("_mf_delta")), rsi_n)
        means["_mf_loss"] = (clip_sign(F.col("_mf_delta"), -1), rsi_n)
    rolled = {}
    if want & {"bb_middle", "bb_upper", "bb_lower"}:
        means[f"_mf_mean_{bb_n}"] = (c, bb_n)
        rolled["_mf_sd"] = rolling_std_col(c, bb_n, keys)
    if "volatility" in want:
        rolled["volatility"] = rolling_std_col(F.col("daily_return"), vol_n, keys)
    rolled |= {nm: rolling_mean_col(x, n, keys) for nm, (x, n) in means.items()}
    t = t.select("*", *[v.alias(k) for k, v in rolled.items()]).where(F.col(OWN))
    last = {nm: F.col(f"_mf_mean_{n}") for n, nm in zip(sma, sma_names) if nm in want}
    if "rsi" in want:
        last["rsi"] = rsi_col(F.col("_mf_gain"), F.col("_mf_loss"))
    if want & {"bb_middle", "bb_upper", "bb_lower"}:
        mid, sd = F.col(f"_mf_mean_{bb_n}"), F.col("_mf_sd")
        last |= {"bb_middle": mid, "bb_upper": mid + sd * bb_k, "bb_lower": mid - sd * bb_k}
    t = t.select("*", *[v.alias(k) for k, v in last.items()])
    if need_signal:
        t = t.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    out = [F.col(n) if gate is None else F.when(F.col(gate), F.col(n)).alias(n)
           for n in names if n in want]
    return t.select(*idx.columns, *out)


def _has_nulls(idx: DataFrame, col: str) -> bool:
    """Whether a price is missing; the filter reaches the staged Parquet scan, where
    row groups without nulls are skipped by their statistics."""
    return not idx.where(F.col(col).isNull()).isEmpty()


def _with_carried_ewm(idx, price, keys, block, ema, signal, names, want, need_signal, gate, **params) -> DataFrame:
    """``indicators_indexed`` for series with missing prices: the EWM columns need their
    values carried through null runs before the signal is taken, so they are added
    first and the trailing frames after them."""
    t = ewm_carried(idx, price, {f"ema_{e}": e for e in ema}, keys, block)
    t = t.withColumn("macd", F.col(f"ema_{ema[0]}") - F.col(f"ema_{ema[1]}"))
    if need_signal:
        t = ewm_carried(t, "macd", {"macd_signal": signal}, keys, block)
        t = t.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    have = [f"ema_{e}" for e in ema] + ["macd", "macd_signal", "macd_histogram"]
    rest = [n for n in names if n in want and n not in have]
    if rest:
        t = indicators_indexed(t, price, keys, block, ema=ema, signal=signal, which=rest, **params)
    out = [F.col(n) if gate is None else F.when(F.col(gate), F.col(n)).alias(n) for n in names if n in want]
    return t.select(*idx.columns, *out)


def indicators(df: DataFrame, price: str = "close", keys: str | Sequence[str] = ("symbol",),
               order: str | Sequence[str] = ("date",), block: int = DEFAULT_BLOCK, **params) -> DataFrame:
    """All 13 indicator columns appended to ``df``."""
    keys, order = _cols(keys), _cols(order)
    return indicators_indexed(series_index(df, keys, order), price, keys, block, **params).drop(IDX)


def _single(df, keys, order, block, halo, make) -> DataFrame:
    keys, order = _cols(keys), _cols(order)
    t = with_blocks(series_index(df, keys, order), block, halo)
    t = make(t, keys)
    return t.where(F.col(OWN)).drop(IDX, BLK, OWN)


def rolling_mean(df: DataFrame, col: str = "close", n: int = 5, out: str | None = None,
                 keys=("symbol",), order=("date",), block: int = DEFAULT_BLOCK) -> DataFrame:
    """pandas ``rolling(n).mean()`` per series."""
    return _single(df, keys, order, block, n - 1,
                   lambda t, k: t.withColumn(out or f"{col}_mean_{n}", rolling_mean_col(F.col(col), n, k)))


def rolling_std(df: DataFrame, col: str = "close", n: int = 20, out: str | None = None,
                keys=("symbol",), order=("date",), block: int = DEFAULT_BLOCK) -> DataFrame:
    """pandas ``rolling(n).std()`` per series."""
    return _single(df, keys, order, block, n - 1,
                   lambda t, k: t.withColumn(out or f"{col}_std_{n}", rolling_std_col(F.col(col), n, k)))


def diff(df: DataFrame, col: str = "close", out: str | None = None,
         keys=("symbol",), order=("date",), block: int = DEFAULT_BLOCK) -> DataFrame:
    """pandas ``diff()`` per series."""
    return _single(df, keys, order, block, 1,
                   lambda t, k: t.withColumn(out or f"{col}_diff", diff_col(F.col(col), k)))


def pct_change(df: DataFrame, col: str = "close", out: str | None = None,
               keys=("symbol",), order=("date",), block: int = DEFAULT_BLOCK) -> DataFrame:
    """Change from the previous row per series; previous 0 or a missing price on
    either side -> null, nothing is padded (I09, I11)."""
    return _single(df, keys, order, block, 1,
                   lambda t, k: t.withColumn(out or "daily_return", pct_change_col(F.col(col), k)))


def ewm_mean(df: DataFrame, col: str = "close", span: float = 12, out: str | None = None,
             keys=("symbol",), order=("date",), block: int = DEFAULT_BLOCK) -> DataFrame:
    """pandas ``ewm(span=span).mean()`` per series as a blocked running sum with an
    ``ewm_halo(span)``-row halo, carried through null runs (I03)."""
    keys, order = _cols(keys), _cols(order)
    name = out or f"ema_{int(span) if float(span).is_integer() else span}"
    idx = series_index(df, keys, order)
    if _has_nulls(idx, col):
        return ewm_carried(idx, col, {name: span}, keys, block).drop(IDX)
    halo, limit = ewm_halo(span), ewm_block_limit(span)
    if halo > limit:
        raise ValueError(f"span {span}: halo {halo} exceeds the exponent limit {limit}")
    B = max(min(block, limit), halo + 1)
    t = with_blocks(idx, B, halo)
    return t.select("*", ewm_col(F.col(col), span, keys, B).alias(name)).where(F.col(OWN)).drop(IDX, BLK, OWN)
