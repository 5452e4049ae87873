"""Mixing sources to target weights by Pfair scheduling (built-in expressions only).

Each source is put in a shuffled order and cut into blocks of ``BLOCK``
characters. With a share ``w`` of ``W``, block k (from
0) of a source may start at slot ``floor(k W / w)``, its release time, and must be
done by ``ceil((k + 1) W / w)``, its deadline; in every slot the released block
with the earliest deadline runs. After any number of slots each source has had
its share of them with less than one block of deviation, until a source is used up.

By default the shares are the target weights themselves (in units of 2 ** -31) and
the schedule has a slot for every block; where sources are used up, the
earliest deadline of what is left runs. With ``slots`` given, shares are rounded to
whole slots of a period of about that length, and the bound holds against the rounded
shares only. That schedule repeats after ``W`` slots, since every source then has had
exactly ``w`` blocks: block k of a source with cycle table ``c`` runs in slot
``(k div w) W + c[k mod w]``, and a source that is used up leaves its slots
empty, the others close up in slot order.

Either schedule is a fold over its slots and the distinct shares, as sources of one
share take turns. It runs in one task: as many steps as there are blocks (or slots of a
period), each over the distinct shares. No driver loop and no global sort decide it.
Every document is kept.

Positions inside a source come from a range partitioning by (source, hash of the
id), so a source with a third of the rows spreads over many tasks, and a prefix
sum over per-partition totals.

Defined results: a null text has no characters but takes one unit, like every
document takes one more than its characters; null sources are one source; ties are
broken by id and length, rows that still tie are alike; a text longer than a block
is one document at one place; an empty table gives
no rows; sources missing from given weights get the smallest share, one unit or slot;
other columns are returned unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BLOCK = 262_144
SLOTS = 1000
#: Units that target weights are counted in; windows of 2 ** 31 blocks still fit a long.
UNITS = 1 << 31
#: Target weight of a source: its share of all characters to this power.
ALPHA = 0.7


def source_sizes(docs: DataFrame, source: Column, size: Column) -> DataFrame:
    """(source, size): characters of each source."""
    return docs.groupBy(source.alias("source")).agg(F.sum(size).alias("size"))


def tempered_weights(sizes: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(source, weight) with weight = size ** alpha: flattens the shares of
    large sources."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(alpha)).alias("weight"))


def slot_shares(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(source, w, period): integer shares of a period that is their sum. Every source
    gets round(slots * weight / total) slots, one at least."""
    every = Window.partitionBy(F.lit(0))  # the whole table, of parameter size
    w = F.greatest(F.lit(1), F.floor(F.lit(slots) * F.col("weight") / F.sum("weight").over(every) + F.lit(0.5)))
    return (weights.select("source", w.cast("long").alias("w"))
                   .withColumn("period", F.sum("w").over(every)))


#: Slots of one inner fold: bounds what is copied when a slot is appended.
CHUNK = 512


def _fold(n: str) -> Column:
    """The fold over slots 0 to ``n`` - 1 as array<struct<c, j>>: in each slot job j of class c
    runs. ``s`` holds the classes in order, (w, m, jobs): m sources of share w, which all have
    the windows of block j div m, in turns. Where nothing is released (sources are used
    up) the earliest deadline of all that is left runs."""
    # had: jobs each class has had; p: the class and job that run in slot t
    due = """transform(s, (x, i) -> if(st.had[i] < x.jobs {released},
        struct(((st.had[i] div x.m + 1) * period + x.w - 1) div x.w AS d, i AS c, st.had[i] AS j), null))"""
    pick = (f"coalesce(array_min({due.format(released='AND (st.had[i] div x.m) * period div x.w <= t')}), "
            f"array_min({due.format(released='')}))")
    step = f"""transform(array({pick}), p -> struct(
        transform(st.had, (h, i) -> if(i = p.c, h + 1L, h)) AS had,
        concat(st.runs, array(struct(p.c AS c, p.j AS j))) AS runs))[0]"""
    none = "CAST(array() AS array<struct<c: int, j: bigint>>)"
    inner = f"""aggregate(sequence(g * {CHUNK}L, least((g + 1) * {CHUNK}L, {n}) - 1),
        struct(o.had AS had, {none} AS runs), (st, t) -> {step})"""
    return F.expr(f"""flatten(aggregate(sequence(0L, ({n} - 1) div {CHUNK}L),
        struct(transform(s, x -> 0L) AS had, CAST(array() AS array<array<struct<c: int, j: bigint>>>) AS runs),
        (o, g) -> transform(array({inner}), e -> struct(e.had AS had, concat(o.runs, array(e.runs)) AS runs))[0],
        o -> o.runs))""")


def period_table(shares: DataFrame) -> DataFrame:
    """(source, w, period, cycle): ``cycle[j]`` is the slot of the source's j-th
    block in one period, by earliest deadline first among released blocks.

    Sources of equal share have equal windows and take turns by name, so the fold walks
    over classes of equal share, of which there are at most sqrt(2 period), however many
    sources there are. Where deadlines are equal, larger shares come first.
    """
    classes = shares.groupBy("period", "w").agg(F.count(F.lit(1)).alias("m")).groupBy("period").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("o"), "w", "m", (F.col("w") * F.col("m")).alias("jobs")))).alias("s"))
    runs = classes.select("period", "s", F.posexplode(_fold("period")).alias("slot", "p"))
    turn = runs.select("slot", F.expr("s[p.c].w").alias("t_w"), F.expr("p.j % s[p.c].m").alias("t_r"))
    named = Window.partitionBy("w").orderBy(F.col("source").isNotNull(), "source")
    ranked = shares.withColumn("r", F.row_number().over(named).cast("long") - 1)
    return (ranked.join(turn, (F.col("w") == F.col("t_w")) & (F.col("r") == F.col("t_r")))
                  .groupBy("source", "w", "period")
                  .agg(F.array_sort(F.collect_list(F.col("slot").cast("long"))).alias("cycle")))


def block_table(lanes: DataFrame) -> DataFrame:
    """(c_lane, c_block, slot) of every block of (source, weight, blocks), by earliest
    deadline first with windows from the target weights."""
    every = Window.partitionBy(F.lit(0))  # one row per source
    part = F.coalesce(F.try_divide(F.col("weight"), F.sum("weight").over(every)), F.lit(0.0))
    shares = (lanes.select("source", "blocks", F.greatest(F.lit(1), F.round(part * UNITS)).cast("long").alias("w"))
                   .withColumn("period", F.sum("w").over(every)).withColumn("n", F.sum("blocks").over(every)))
    alike = Window.partitionBy("w", "blocks").orderBy(F.col("source").isNotNull(), "source")
    ranked = stage(shares.withColumn("r", F.row_number().over(alike).cast("long") - 1), "mix-shares")
    classes = ranked.groupBy("period", "n", "w", "blocks").agg(F.count(F.lit(1)).alias("m")).groupBy("period", "n").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("o"), "w", "blocks", "m",
                                             (F.col("blocks") * F.col("m")).alias("jobs")))).alias("s"))
    runs = classes.select("s", F.posexplode(_fold("n")).alias("slot", "p"))
    turn = runs.select(F.col("slot").cast("long").alias("slot"), F.expr("s[p.c].w").alias("t_w"),
                       F.expr("s[p.c].blocks").alias("t_blocks"), F.expr("p.j % s[p.c].m").alias("t_r"),
                       F.expr("p.j div s[p.c].m").alias("c_block"))
    return (turn.join(ranked, (F.col("w") == F.col("t_w")) & (F.col("blocks") == F.col("t_blocks")) & (F.col("r") == F.col("t_r")))
                .select(F.col("source").alias("c_lane"), "c_block", "slot"))


# ------------------------------------------------------------------ places of documents

def size_of(text_col: str) -> Column:
    return F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1


def _classes(sizes: DataFrame, weights: DataFrame | None, alpha: float, max_sources: int | None) -> DataFrame:
    """(lane_source, lane, weight): every source, or the ``max_sources`` heaviest, have a lane
    of their own. ``lane`` is a number from 0 in order of weight."""
    if weights is None:
        t = tempered_weights(sizes, alpha)
    else:
        given = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("w"))
        t = (sizes.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left")
                  .select("source", F.coalesce("w", F.lit(0.0)).alias("weight")))
    # one row per source
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("weight").desc(), F.col("source").asc_nulls_first())
    lanes = t.select(F.col("source").alias("lane_source"), (F.row_number().over(order) - 1).alias("lane"), "weight")
    return lanes if max_sources is None else lanes.filter(F.col("lane") < max_sources)


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block: int = BLOCK, slots: int | None = None, alpha: float = ALPHA,
        max_sources: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, lane, block, slot and
    ``at`` (characters of its lane before it). The mixed order is that of
    (slot, at, doc_id).

    ``weights`` has (source, weight); without it each source weighs its share
    of all characters to the power ``alpha``. Every source has a lane of its own;
    only where ``max_sources`` is given, the sources beyond the heaviest share one. Shares
    are the weights themselves, or rounded to a period of ``slots`` where that is given.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"))
    narrow = stage(narrow, "mix-rows")
    sizes = stage(source_sizes(narrow, F.col("source"), F.col("size")), "mix-sizes")
    named = stage(_classes(sizes, weights, alpha, max_sources), "mix-lanes")
    own = sizes.join(named, F.col("source").eqNullSafe(F.col("lane_source")), "left")
    rest = F.lit(max_sources if max_sources is not None else -1)  # a shared lane only where asked for
    lanes = own.groupBy(F.coalesce("lane", rest).alias("source")).agg(
        F.sum(F.coalesce("weight", F.lit(0.0))).alias("weight"),
        (F.floor((F.sum("size") - 1) / F.lit(block)) + 1).cast("long").alias("blocks"))
    if slots is None:
        cycles = stage(block_table(lanes), "mix-blocks")
    else:
        cycles = stage(period_table(slot_shares(lanes, slots)).withColumnRenamed("source", "c_lane"), "mix-cycles")

    keyed = (narrow.join(named, F.col("source").eqNullSafe(F.col("lane_source")), "left")
                   .select("doc_id", "source", "size", F.coalesce("lane", rest).alias("lane"),
                           F.md5(F.col("doc_id").cast("string")).alias("h")))
    order = ["lane", "h", "doc_id", "size"]
    placed = (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("doc_id", "source", "size", "lane", F.monotonically_increasing_id().alias("pos")))
    placed = stage(placed.withColumn("part", F.shiftright("pos", 33)), "mix-order")
    parts = placed.groupBy("lane", "part").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("lane").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("lane").alias("p_lane"), F.col("part").alias("p_part"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    here = Window.partitionBy("lane", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("here", F.coalesce(F.sum("size").over(here), F.lit(0)))
    at = (run.join(parts, (run["lane"] == parts["p_lane"]) & (run["part"] == parts["p_part"]))
             .withColumn("at", F.col("base") + F.col("here"))
             .withColumn("block", F.floor(F.col("at") / F.lit(block)).cast("long")))
    if slots is None:
        done = at.join(cycles, (F.col("lane") == F.col("c_lane")) & (F.col("block") == F.col("c_block")))
        slot = F.col("slot")
    else:
        done = at.join(cycles, F.col("lane") == F.col("c_lane"))
        slot = F.expr("(block div w) * period + cycle[cast(block % w as int)]")
    return done.select("doc_id", "source", "size", "lane", "block", slot.alias("slot"), "at")


def mixed(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs``, all rows and columns, in the mixed order: partition by partition
    and row by row, so files written from it hold the interleaved stream. Rows
    that share an id share the first place of that id."""
    place = mix(docs, weights, id_col, **kw).groupBy("doc_id").agg(F.min(F.struct("slot", "at")).alias("place"))
    place = place.select(F.col("doc_id").alias("p_id"), "place")
    wide = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("id"))
    j = wide.join(place, F.col("id").eqNullSafe(F.col("p_id")))
    order = ["place", "id"]
    return j.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")
