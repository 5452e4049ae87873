"""Indicators of new rows from a per-series state instead of the whole history (I02-I12 with T01).

What the indicators of a series' next rows need from its past is small: the last ``TAIL`` prices for
the trailing frames (20 returns reach 21 prices back), and for each EWM one value and the weight behind
it, since ``sum(d^(i-j) x_j)`` and ``sum(d^(i-j))`` both decay by ``d`` a row. The state of a
series is these last rows, the EWM values and weights on the very last one. A batch is
appended to it as rows of one series: the state's last row enters an EWM as one observation with its
weight, so the result is that of the whole series, and the new state is the last rows again.

The work of a batch is its rows and ``TAIL`` rows a series, whatever the history; a hot series is
cut into blocks as in ``series``. Rows must come after the rows of their series that the state
stands for: ``split_late`` puts others aside, whose series have to be computed anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip_sign
from ..session import materialize
from .indicators import INDICATOR_COLUMNS, rsi_col
from .series import (BLK, DEFAULT_BLOCK, IDX, OWN, _cols, block_window, diff_col, ewm_block_limit, ewm_decay, ewm_halo,
                     fill_indexed, pct_change_col, rolling_mean_col, rolling_std_col, series_index, with_blocks)

EMA = (12, 26)
SIGNAL = 9
#: Rows of a series that the state keeps: a return needs one more price than the 20 returns of a frame.
TAIL = 20
NEW, LAST, POS = "_mf_new", "_mf_state_last", "_mf_state_pos"
_EWMS = {**{f"ema_{s}": s for s in EMA}, "macd_signal": SIGNAL}


def _weight(name: str) -> str:
    return f"_mf_w_{name}"


def _ewm(x: Column, name: str, keys: Sequence[str], block: int) -> tuple[Column, Column]:
    """(value, weight) of an EWM: new rows with ``x`` weigh 1, the state's last row what it stands for."""
    d = ewm_decay(_EWMS[name])
    local = (F.col(IDX) - F.col(BLK) * block).cast("double")
    w = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    inv, zero = F.pow(F.lit(d), -local), F.lit(0.0)
    mine = F.col(NEW) & x.isNotNull()
    state = F.col(LAST) & F.col(f"_mf_s_{_weight(name)}").isNotNull()
    at = F.when(mine, inv).when(state, F.col(f"_mf_s_{_weight(name)}") * inv)
    num = F.sum(F.coalesce(at * F.when(mine, x).otherwise(F.col(f"_mf_s_{name}")), zero)).over(w)
    den = F.sum(F.coalesce(at, zero)).over(w)
    return F.when(den > 0, num / den), den * F.pow(F.lit(d), local)


def _carried(t: DataFrame, names: Sequence[str], seen: Column, keys: list[str]) -> DataFrame:
    """EWM values on rows without an observation: those of the row before, over any number of rows."""
    value = {n: F.when(F.col(NEW), F.when(seen, F.col(n))).otherwise(F.when(F.col(LAST), F.col(f"_mf_s_{n}"))) for n in names}
    t = materialize(t.where(F.col(OWN)).drop(BLK, OWN).withColumns(value), "incremental-ewm")
    return fill_indexed(with_blocks(t, DEFAULT_BLOCK, 0), list(names), keys, backward=False).drop(BLK, OWN)


def indicators_incremental(new: DataFrame, state: DataFrame | None = None, price: str = "close",
                           keys: str | Sequence[str] = ("symbol",), order: str | Sequence[str] = ("date",),
                           block: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(``new`` with the 13 indicator columns, new state). ``state`` is what the call for the batch before
    returned (store it as a table), None for the first one. Series without new rows keep their state."""
    keys, order = _cols(keys), _cols(order)
    stored = [f"_mf_s_{c}" for n in _EWMS for c in (n, _weight(n))]
    rows = new.withColumns({NEW: F.lit(True), LAST: F.lit(False), POS: F.lit(None).cast("bigint"),
                            **{c: F.lit(None).cast("double") for c in stored}})
    if state is not None:
        old = state.select(*keys, *order, price, F.lit(False).alias(NEW), LAST, POS, *stored)
        rows = rows.unionByName(old, allowMissingColumns=True)
    idx = series_index(rows, keys, [NEW, POS, *order], with_len=True)
    idx = materialize(idx.withColumnRenamed("_mf_len", "_mf_rows"), "incremental")
    gaps = not idx.where(F.col(NEW) & F.col(price).isNull()).isEmpty()
    halo = max(TAIL, max(ewm_halo(s) for s in EMA) + ewm_halo(SIGNAL))
    B = max(min(block, *(ewm_block_limit(s) for s in _EWMS.values())), halo + 1)
    c, macd = F.col(price), [f"ema_{s}" for s in EMA]

    def add(t: DataFrame, names: Sequence[str], x: Column) -> DataFrame:
        got = {n: _ewm(x, n, keys, B) for n in names}
        return t.withColumns({**{n: v for n, (v, _) in got.items()}, **{_weight(n): w for n, (_, w) in got.items()}})

    t = with_blocks(idx, B, halo)
    if gaps:  # values have to cross null runs before the signal is taken
        t = _carried(add(t, macd, c), macd, c.isNotNull(), keys)
        t = t.withColumn("macd", F.col(macd[0]) - F.col(macd[1]))
        t = add(with_blocks(t, B, halo), ["macd_signal"], F.col("macd"))
        t = _carried(t, ["macd_signal"], F.col("macd").isNotNull(), keys)
        t = with_blocks(t, B, halo)
        signal = {}
    else:
        t = add(t, macd, c).withColumn("macd", F.col(macd[0]) - F.col(macd[1]))
        signal = _ewm(F.col("macd"), "macd_signal", keys, B)
        signal = {"macd_signal": signal[0], _weight("macd_signal"): signal[1]}
    t = t.withColumns({"daily_return": pct_change_col(c, keys), "_mf_delta": diff_col(c, keys)})
    gain, loss = clip_sign(F.col("_mf_delta")), clip_sign(F.col("_mf_delta"), -1)
    mid, sd = rolling_mean_col(c, 20, keys), rolling_std_col(c, 20, keys)
    t = t.withColumns({
        **signal, "sma_5": rolling_mean_col(c, 5, keys), "sma_20": mid, "bb_middle": mid, "bb_upper": mid + sd * 2.0,
        "bb_lower": mid - sd * 2.0, "rsi": rsi_col(rolling_mean_col(gain, 14, keys), rolling_mean_col(loss, 14, keys)),
        "volatility": rolling_std_col(F.col("daily_return"), 20, keys)}).where(F.col(OWN))
    t = materialize(t.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")), "incremental-rows")
    last = F.col(IDX) == F.col("_mf_rows") - 1
    value = lambda n: F.when(F.col(NEW), F.col(n)).otherwise(F.col(f"_mf_s_{n}"))
    new_state = t.where(F.col(IDX) >= F.col("_mf_rows") - TAIL).select(
        *keys, *order, price, last.alias(LAST), F.col(IDX).alias(POS),
        *[F.when(last, value(n) if c == n else F.when(F.col(NEW), F.col(c)).otherwise(F.col(f"_mf_s_{c}"))).alias(f"_mf_s_{c}")
          for n in _EWMS for c in (n, _weight(n))])
    return t.where(F.col(NEW)).select(*new.columns, *INDICATOR_COLUMNS), new_state


def split_late(new: DataFrame, state: DataFrame, keys: str | Sequence[str] = ("symbol",),
               order: str | Sequence[str] = ("date",)) -> tuple[DataFrame, DataFrame]:
    """(rows that may be appended, late rows): late ones do not come after the last row of their series."""
    keys, order = _cols(keys), _cols(order)
    last = state.where(F.col(LAST)).select(*[F.col(k).alias(f"_mf_k{j}") for j, k in enumerate(keys)],
                                           F.struct(*order).alias("_mf_end"))
    on = F.lit(True)
    for j, k in enumerate(keys):
        on = on & new[k].eqNullSafe(F.col(f"_mf_k{j}"))
    t = new.join(last, on, "left").withColumn("_mf_late", F.coalesce(F.struct(*order) <= F.col("_mf_end"), F.lit(False)))
    pick = lambda c: t.where(c).select(*new.columns)
    return pick(~F.col("_mf_late")), pick(F.col("_mf_late"))
