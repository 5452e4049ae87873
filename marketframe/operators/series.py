"""Series index and blocked windows.

A *series* is the rows of one key (``symbol``) ordered by an order key
(``date``). A window partitioned by the key alone sorts a whole series in one
task, so a symbol holding a third of the table would run on one core. Here a
series is cut into blocks of ``B`` consecutive rows instead:

1. ``series_index`` gives every row its 0-based position ``i`` in its series
   without a per-series task: a range-partitioned global sort (the range
   partitioner samples the data and splits a hot key over many partitions),
   ``monotonically_increasing_id`` inside each sorted partition, and a prefix
   sum over the small ``(key, partition) -> row count`` table.
2. ``with_blocks`` assigns block ``b = i div B`` and copies the last ``halo``
   rows of each block into the next one, so trailing frames of up to
   ``halo + 1`` rows are exact inside ``Window.partitionBy(key, b)``.
3. EWM: weights of rows more than ``H = ceil((46 + ln(1/(1-d))) / -ln d)``
   back are below 1e-20 of the mass of a non-null row, so a halo of H rows turns the
   EWM into a running sum inside the block - exact to double precision; null
   runs carry the last value (``ewm_carried``).
4. Unbounded frames that reach the series start (forward/backward fill)
   combine a per-block value with a carry from the block table (``B`` times
   smaller than the data), scanned in two levels so that no task holds a
   whole series even there.

All windows of one pass share ``partitionBy(key, b).orderBy(i)``, so Catalyst
plans one exchange and one sort for them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

IDX = "_mf_i"     # position in the series
BLK = "_mf_b"     # block the row is evaluated in
OWN = "_mf_own"   # false for halo copies
DEFAULT_BLOCK = 2048
WHOLE_ROWS = 2_000_000  # rows up to which one task sorts a series whole


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def series_index(df: DataFrame, keys: str | Sequence[str] = ("symbol",),
                 order: str | Sequence[str] = ("date",),
                 num_partitions: int | None = None, with_len: bool = False,
                 tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Add ``_mf_i``: 0-based position of each row within its series
    (and ``_mf_len``, the series length, with ``with_len``).

    Order: ``order`` ascending with nulls last (as pandas ``sort_values``);
    the remaining orderable columns break ties, so rows that still tie are
    identical and any order among them gives the same result (``tiebreak``
    names the tie columns instead, e.g. ``[]`` when ``order`` is unique per
    key or the table carries wide text columns). A last key - the row's
    position after a local sort of its input partition - spreads such copies
    (a third of the table may be one repeated row, or one repeated value in a
    median column) over many range partitions instead of one, and is the
    same on every re-run of a task.

    The sorted, tagged rows are written once to the shared checkpoint
    folder; the count branch and the row branch both scan that table instead
    of each re-deriving ``df`` (and its shuffles), and both see the same
    positions. The range exchange thus has a single consumer and is left to
    AQE: it starts from ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``
    (or the shuffle partitions) and coalesces to the advisory partition size;
    ``num_partitions`` fixes the count instead.
    """
    keys, order = _cols(keys), _cols(order)
    if tiebreak is None:
        tail = [c for c in df.columns
                if c not in keys and c not in order and _orderable(df.schema[c].dataType)]
    else:
        tail = list(tiebreak)
    sort_exprs = ([F.col(k).asc_nulls_first() for k in keys]
                  + [F.col(o).asc_nulls_last() for o in order]
                  + [F.col(c).asc_nulls_first() for c in tail]
                  + [F.col("_mf_salt").asc()])
    df_in = df
    # Salt from the row's position after a local sort of its input partition
    # (as Spark's own round-robin repartition does): a partition's contents
    # are deterministic even when the arrival order of a shuffle read is not,
    # so a re-run task salts every row as the first attempt did.
    # The local sort needs only a content hash: rows that differ are placed by
    # their content anyway, and rows with equal content are interchangeable.
    hashable = [c for c in df.columns if _orderable(df.schema[c].dataType)]
    df = (df.sortWithinPartitions(F.xxhash64(*[F.col(c) for c in hashable]))
            .withColumn("_mf_salt", F.monotonically_increasing_id()))
    if num_partitions is None:
        ranged = df.repartitionByRange(*sort_exprs)
    else:
        ranged = df.repartitionByRange(num_partitions, *sort_exprs)
    t = ranged.sortWithinPartitions(*sort_exprs).withColumn("_mf_mid", F.monotonically_increasing_id())
    t = t.select(*df_in.columns, F.shiftright("_mf_mid", 33).alias("_mf_pid"),
                 F.col("_mf_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_mf_pos"))
    t = materialize(t, "series-index")
    # (key, partition) -> rows; at most (#partitions + #series) rows.
    parts = t.groupBy(*keys, "_mf_pid").agg(F.count(F.lit(1)).alias("_mf_n"),
                                            F.min("_mf_pos").alias("_mf_p0"))
    wk = Window.partitionBy(*keys)
    before = wk.orderBy("_mf_pid").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_mf_n").over(wk).alias("_mf_len2")] if with_len else []
    parts = parts.select(*[F.col(k).alias(f"_mf_k{j}") for j, k in enumerate(keys)],
                         F.col("_mf_pid").alias("_mf_pid2"), "_mf_p0",
                         F.coalesce(F.sum("_mf_n").over(before), F.lit(0)).alias("_mf_start"), *extra)
    cond = [t[k].eqNullSafe(parts[f"_mf_k{j}"]) for j, k in enumerate(keys)]
    cond.append(t["_mf_pid"] == parts["_mf_pid2"])
    out = t.join(parts, cond, "inner")
    return out.select(*[t[c] for c in df_in.columns],
                      (F.col("_mf_start") + F.col("_mf_pos") - F.col("_mf_p0")).alias(IDX),
                      *([F.col("_mf_len2").alias("_mf_len")] if with_len else []))


def block_of(i: Column, block: int) -> Column:
    return F.floor(i / F.lit(block)).cast("long")


def with_blocks(indexed: DataFrame, block: int = DEFAULT_BLOCK, halo: int = 0) -> DataFrame:
    """Add ``_mf_b`` and ``_mf_own``; rows in the last ``halo`` positions of a
    block are also emitted (``_mf_own`` false) into the next block."""
    if halo >= block:
        raise ValueError(f"halo {halo} must be smaller than the block size {block}")
    b = block_of(F.col(IDX), block)
    if halo > 0:
        local = F.col(IDX) - b * block
        targets = F.when(local >= block - halo, F.array(F.struct(b.alias("b"), F.lit(True).alias("own")),
                                                         F.struct((b + 1).alias("b"), F.lit(False).alias("own"))))
        targets = targets.otherwise(F.array(F.struct(b.alias("b"), F.lit(True).alias("own"))))
        t = indexed.select("*", F.inline(targets))
        return t.withColumnsRenamed({"b": BLK, "own": OWN})
    return indexed.select("*", b.alias(BLK), F.lit(True).alias(OWN))


def block_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(IDX)


# ---------------------------------------------------------------- trailing frames

def trailing(keys: Sequence[str], n: int):
    return block_window(keys).rowsBetween(-(n - 1), 0)


def rolling_mean_col(c: Column, n: int, keys: Sequence[str]) -> Column:
    """pandas ``rolling(n).mean()``: null until the frame holds n non-null values."""
    w = trailing(keys, n)
    return F.when(F.count(c).over(w) == n, F.avg(c).over(w))


def rolling_std_col(c: Column, n: int, keys: Sequence[str]) -> Column:
    """pandas ``rolling(n).std()`` (sample, ddof 1)."""
    w = trailing(keys, n)
    return F.when(F.count(c).over(w) == n, F.stddev_samp(c).over(w))


def diff_col(c: Column, keys: Sequence[str]) -> Column:
    return c - F.lag(c, 1).over(block_window(keys))


def pct_change_col(c: Column, keys: Sequence[str]) -> Column:
    """x / previous - 1; previous 0 gives null (pandas gives inf)."""
    return F.try_divide(c, F.lag(c, 1).over(block_window(keys))) - F.lit(1.0)


# ---------------------------------------------------------------- fills

def fill_indexed(blocked: DataFrame, cols: Sequence[str], keys: Sequence[str],
                 fanout: int = 2048, backward: bool = True) -> DataFrame:
    """Forward then (unless ``backward`` is false) backward fill of ``cols`` on a
    blocked frame without halo.

    Within a block: ``last`` ignoring nulls; a row that finds none before it takes the
    block's first, which the block table has. Across blocks the
    last (first) non-null value of earlier (later) blocks comes from the
    block table, scanned in two levels - blocks within super-blocks of
    ``fanout`` blocks, then super-blocks per series - so no task ever holds
    more than ``fanout`` blocks or (rows / (B * fanout)) super-blocks of one
    series.
    """
    if not cols:
        return blocked
    keys = list(keys)
    # the data crosses once: the in-block windows and the join with the carries are both on the
    # normalized keys, so one exchange and one sort serve them
    norm = [f"_mf_n{j}{part}" for j in range(len(keys)) for part in ("", "z")]
    normalized = [c for j, k in enumerate(keys) for c in _normalized(blocked, k, f"_mf_n{j}")]
    w = Window.partitionBy(*norm, BLK).orderBy(IDX)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    SB = "_mf_sb"
    tbl = blocked.groupBy(*keys, BLK).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(IDX))).alias(f"_mf_last_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(IDX))).alias(f"_mf_first_{c}") for c in cols])
    tbl = tbl.withColumn(SB, F.floor(F.col(BLK) / fanout).cast("long"))
    # level 1: inside a super-block
    w1 = Window.partitionBy(*keys, SB).orderBy(BLK)
    w1_back = Window.partitionBy(*keys, SB).orderBy(F.col(BLK).desc())
    lvl1 = tbl.select(
        *keys, BLK, SB,
        *[F.last(f"_mf_last_{c}", True).over(w1.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_mf_ff1_{c}")
          for c in cols],
        *[F.last(f"_mf_first_{c}", True).over(w1_back.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_mf_bf1_{c}")
          for c in cols],
        *[F.col(f"_mf_last_{c}") for c in cols], *[F.col(f"_mf_first_{c}") for c in cols])
    # level 2: super-blocks of a series
    sup = lvl1.groupBy(*[F.col(k).alias(f"_mf_s{j}") for j, k in enumerate(keys)], F.col(SB).alias("_mf_sb2")).agg(
        *[F.max_by(f"_mf_last_{c}", F.when(F.col(f"_mf_last_{c}").isNotNull(), F.col(BLK))).alias(f"_mf_sl_{c}")
          for c in cols],
        *[F.min_by(f"_mf_first_{c}", F.when(F.col(f"_mf_first_{c}").isNotNull(), F.col(BLK))).alias(f"_mf_sf_{c}")
          for c in cols])
    w2 = Window.partitionBy(*[f"_mf_s{j}" for j in range(len(keys))]).orderBy("_mf_sb2")
    w2_back = Window.partitionBy(*[f"_mf_s{j}" for j in range(len(keys))]).orderBy(F.col("_mf_sb2").desc())
    sup = sup.select(
        *[f"_mf_s{j}" for j in range(len(keys))], "_mf_sb2",
        *[F.last(f"_mf_sl_{c}", True).over(w2.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_mf_ff2_{c}")
          for c in cols],
        *[F.last(f"_mf_sf_{c}", True).over(w2_back.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_mf_bf2_{c}")
          for c in cols])
    cs = [lvl1[k].eqNullSafe(sup[f"_mf_s{j}"]) for j, k in enumerate(keys)] + [lvl1[SB] == sup["_mf_sb2"]]
    carry = lvl1.join(sup, cs, "left").select(
        *[c for j, k in enumerate(keys) for c in _normalized(lvl1, k, f"_mf_n{j}")], BLK,
        *[F.coalesce(F.col(f"_mf_ff1_{c}"), F.col(f"_mf_ff2_{c}")).alias(f"_mf_ff_{c}") for c in cols],
        *[F.coalesce(F.col(f"_mf_first_{c}"), F.col(f"_mf_bf1_{c}"), F.col(f"_mf_bf2_{c}")).alias(f"_mf_bf_{c}")
          for c in cols])
    own = blocked.select("*", *normalized)
    own = own.select("*", *[F.last(c, True).over(before).alias(f"_mf_fw_{c}") for c in cols])
    j = own.join(carry, [*norm, BLK], "left")
    back = lambda c: [F.col(f"_mf_bf_{c}")] if backward else []
    filled = {c: F.coalesce(F.col(f"_mf_fw_{c}"), F.col(f"_mf_ff_{c}"), *back(c)).alias(c) for c in cols}
    return j.select(*[filled.get(c, F.col(c)) for c in blocked.columns])


def fill_whole(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The fills of ``fill_indexed`` in the order of ``series_index``, each series sorted by one task: one
    exchange and one sort. A row without a value before it takes the first of its series."""
    tail = [c for c in df.columns if c not in keys and c not in order and _orderable(df.schema[c].dataType)]
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_last() for o in order], *[F.col(c).asc_nulls_first() for c in tail])
    before, every = (w.rowsBetween(Window.unboundedPreceding, end) for end in (0, Window.unboundedFollowing))
    return df.select(*[F.coalesce(F.last(c, True).over(before), F.first(c, True).over(every)).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


def fill_series(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                block: int = DEFAULT_BLOCK, whole: int = WHOLE_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Forward then backward fill of ``cols`` per series. Series of up to ``whole`` rows go through
    ``fill_whole``, longer ones (at most one in ``whole`` rows) are cut into blocks, so no task sorts more
    than that of one series. ``counted``: a frame that costs less than ``df`` and has its rows at least once."""
    if not cols:
        return df
    many = (df if counted is None else counted).groupBy(*[F.col(k).alias(f"_mf_k{j}") for j, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_mf_rows"))
    many = materialize(many.where(F.col("_mf_rows") > whole).drop("_mf_rows"), "long-series")
    if many.isEmpty():
        return fill_whole(df, cols, keys, order)
    df = materialize(df, "series-rows")   # both ways read it
    on = [df[k].eqNullSafe(many[f"_mf_k{j}"]) for j, k in enumerate(keys)]
    cut = with_blocks(series_index(df.join(many, on, "left_semi"), keys, order), block, 0)
    return fill_whole(df.join(many, on, "left_anti"), cols, keys, order).unionByName(
        fill_indexed(cut, cols, keys).drop(IDX, BLK, OWN))


def _normalized(df: DataFrame, key: str, name: str) -> list[Column]:
    """A key as two columns without nulls (value or a stand-in, and whether it is null), whose plain
    equality is the key's null-safe one."""
    kind = df.schema[key].dataType
    stand_in = (F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind) if isinstance(kind, T.NumericType)
                else F.lit("1970-01-01").cast(kind) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else None)
    value = F.coalesce(df[key], stand_in) if stand_in is not None else F.coalesce(df[key].cast("string"), F.lit(""))
    return [value.alias(name), df[key].isNull().alias(f"{name}z")]


# ---------------------------------------------------------------- EWM

def ewm_decay(span: float) -> float:
    if span < 1:
        raise ValueError("span must be >= 1")
    return 1.0 - 2.0 / (span + 1.0)


def ewm_halo(span: float) -> int:
    """Rows of history after which the remaining EWM weight is < 1e-20 of
    the window mass (so truncating there is exact in double precision)."""
    d = ewm_decay(span)
    if d == 0.0:
        return 0
    return math.ceil((46.0 + math.log(1.0 / (1.0 - d))) / -math.log(d))


def ewm_block_limit(span: float) -> int:
    """Largest |row offset| for which d^offset stays far from double overflow."""
    d = ewm_decay(span)
    if d == 0.0:
        return 1 << 30
    return max(1, int(650.0 / -math.log(d)))


def ewm_col(x: Column, span: float, keys: Sequence[str], block: int) -> Column:
    """pandas ``ewm(span, adjust=True).mean()`` inside blocked windows.

    ``y_i = sum_j d^(i-j) x_j / sum_j d^(i-j)`` over non-null ``x_j`` (nulls
    keep decaying, as pandas with ``ignore_na=False``), ``d = 1 - 2/(span+1)``,
    written as ``d^l * running_sum(x_j d^-l_j)`` with ``l`` the offset from
    the block's own first row (halo rows have negative ``l``). Exact on rows where
    ``x`` is not null when the block carries at least ``ewm_halo(span)`` halo rows:
    such a row has weight 1, all rows before the halo together below 1e-20. On a
    null row the last value may lie before the halo; ``ewm_carried`` brings it.
    """
    d = ewm_decay(span)
    local = (F.col(IDX) - F.col(BLK) * block).cast("double")
    w = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    ok = x.isNotNull()
    if d == 0.0:
        return F.when(ok, x)
    inv = F.pow(F.lit(d), -local)
    num = F.sum(F.when(ok, x * inv).otherwise(F.lit(0.0))).over(w)
    den = F.sum(F.when(ok, inv).otherwise(F.lit(0.0))).over(w)
    return F.when(den > 0, num / den)


def ewm_carried(idx: DataFrame, x: str, spans: dict[str, float], keys: Sequence[str], block: int) -> DataFrame:
    """EWM columns (name -> span) of ``x`` on an indexed frame, for series with nulls: evaluated
    on the non-null rows, where the halo makes it exact, then carried through null
    runs of any length by the two-level fill. The result does not depend on ``block``."""
    keys = list(keys)
    halo = max(ewm_halo(s) for s in spans.values())
    limit = min(ewm_block_limit(s) for s in spans.values())
    if halo > limit:
        raise ValueError(f"EWM halo {halo} exceeds the exponent limit {limit}")
    B = max(min(block, limit), halo + 1)
    t = with_blocks(idx, B, halo)
    seen = F.col(x).isNotNull()
    t = t.select("*", *[F.when(seen, ewm_col(F.col(x), s, keys, B)).alias(n) for n, s in spans.items()])
    t = materialize(t.where(F.col(OWN)).drop(BLK, OWN), "ewm")   # the fill reads it twice
    return fill_indexed(with_blocks(t, DEFAULT_BLOCK, 0), list(spans), keys, backward=False).drop(BLK, OWN)
