"""Last known prices across batches: a backward as-of join (C03 with SURVEY D2).

Price fills stop at the batch (file), so a batch that begins with gaps has nothing to fill them from but
its own later rows. The last-known table has one row per (symbol, batch): the last price of each
column in that batch. A batch's gaps before its first price take the newest value of the symbol's
*earlier* batches; nothing is ever taken from a later batch or a later row, so the result of a batch does
not depend on which batches run together with it, only on those before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import PRICE_COLUMNS
from .series import BLK, DEFAULT_BLOCK, IDX, OWN, _cols, fill_indexed, series_index, with_blocks


def batch_time(batch: str) -> Column:
    """Order of batches: the time in a ``yyyyMMdd_HHmmss`` id, then the id itself."""
    return F.struct(F.try_to_timestamp(F.col(batch).cast("string"), F.lit("yyyyMMdd_HHmmss")), F.col(batch))


def last_prices(rows: DataFrame, cols: Sequence[str] | None = None, keys: str | Sequence[str] = ("symbol",),
                order: str | Sequence[str] = ("timestamp",), batch: str = "batch_id") -> DataFrame:
    """(keys, batch, cols): the last price of each column in each batch; of rows of equal order
    the largest price. A grouped maximum, one row per series and batch."""
    keys, order = _cols(keys), _cols(order)
    cols = [c for c in (PRICE_COLUMNS if cols is None else cols) if c in rows.columns]
    return rows.groupBy(*keys, batch).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_mf_v"))))["_mf_v"].alias(c) for c in cols])


def known_before(known: DataFrame, cols: Sequence[str], keys: Sequence[str], batch: str) -> DataFrame:
    """(keys, batch, cols): for every batch of the last-known table, the newest values before it. The window
    runs over one row per batch of a series."""
    w = Window.partitionBy(*keys).orderBy(batch_time(batch)).rowsBetween(Window.unboundedPreceding, -1)
    return known.select(*keys, batch, *[F.last(c, True).over(w).alias(c) for c in cols])


def carry_prices(rows: DataFrame, known: DataFrame | None = None, cols: Sequence[str] | None = None,
                 keys: str | Sequence[str] = ("symbol",), order: str | Sequence[str] = ("timestamp",),
                 batch: str = "batch_id", block: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with gaps filled, last-known rows of their batches). A gap takes the price before it
    in its batch, else the newest price of an earlier batch: of those in ``rows``, or in ``known``, the
    last-known rows that earlier calls returned (a batch that runs again stands for itself)."""
    keys, order = _cols(keys), _cols(order)
    cols = [c for c in (PRICE_COLUMNS if cols is None else cols) if c in rows.columns]
    t = fill_indexed(with_blocks(series_index(rows, [batch, *keys], order), block, 0), cols, [batch, *keys],
                     backward=False).drop(IDX, BLK, OWN)
    mine = last_prices(rows, cols, keys, order, batch)
    every = mine
    if known is not None:
        again = mine.select(batch).distinct()
        every = mine.unionByName(known.select(*keys, batch, *cols).join(again, batch, "left_anti"))
    before = known_before(every, cols, keys, batch).select(
        *[F.col(k).alias(f"_mf_k{j}") for j, k in enumerate([*keys, batch])], *[F.col(c).alias(f"_mf_c_{c}") for c in cols])
    on = F.lit(True)
    for j, k in enumerate([*keys, batch]):
        on = on & t[k].eqNullSafe(F.col(f"_mf_k{j}"))
    out = t.join(before, on, "left").select(*[F.coalesce(t[c], F.col(f"_mf_c_{c}")).alias(c) if c in cols else t[c]
                                              for c in rows.columns])
    return out, mine
