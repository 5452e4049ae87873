"""Conversation structure repair by an auction shortest-path algorithm.

A conversation is brought to the form: an optional system turn, then user and assistant turns
in alternation, by the cheapest edits of its rows: keep (0), give another role (2), delete (3;
a must for blank and repeated rows) or insert an empty turn (2); a truncated row that stays costs
1 more. Rows and the four states of the form (nothing yet, after system, after user, after
assistant) are a lattice with integer arc costs, and the cheapest edits are a shortest path.

The auction keeps a price per node with ``price[i] <= cost[i, j] + price[j]`` on all arcs, and a
path from the origin. At the path's end i the best arc's ``cost + price`` either equals the price
(the path is extended along it) or is larger (the price rises to it and the path is cut back by
a node). When the path reaches the end of the lattice the origin's price is the distance, and
every arc of every cheapest path is tight. The tight arcs that lead to the end are then followed,
at each node the one whose edit letter (D, I, K, R) is least.

Long conversations are cut into blocks of ``BLOCK`` rows, so no task walks one as a whole:
auctions give each block's distances between its entry and exit states (blocks in parallel), a fold
over these 4 x 4 tables per conversation gives the distance from each block's end (an entry per
block, less than the letters of the audit it returns), auctions with these as exit costs
give each block's edits for every entry state (parallel again), and a fold picks the entry states.
Conversations of one block, nearly all, take one auction.

Scale: rows get their positions from the series index (a range-partitioned sort that splits
a hot conversation). A row is a letter to the auction, so texts do not go to it. First
occurrences of (role, text) are found by grouping, and only repeated ones are joined back. The digest of a
repaired conversation is a sequential hash: its rows stream through one task in batches.

Defined results: null roles and texts count as one space (such a text is blank, such a role fits
no place of the form, nor does an empty one); null ids are one conversation; rows without a turn come
first; rows of equal turn are ordered by role, then SHA-256 of the text; repeated rows are duplicates;
very long texts are whole; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import IDX, series_index
from .common import SPACE_CHARS, stage

BLOCK = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the form, and where the next user, assistant or system turn leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Row letters: the role's initial (o: another), upper case if truncated, a digit if it must go.
INITIALS = "suao"
INF = 1 << 40

Arc = tuple[str, int, int]  # edit letter, cost, head


def _initial(letter: str) -> str:
    return INITIALS[int(letter)] if letter.isdigit() else letter.lower()


def lattice(letters: str, exits: tuple[int, ...], last: bool) -> list[list[Arc]]:
    """Arcs of each node (4 * rows before it + state); the end of the lattice is the last node.
    ``exits``: cost from each state at the end (INF: none). Only the last block
    inserts behind its last row, as a block's end is the next one's beginning."""
    end = 4 * (len(letters) + 1)
    arcs: list[list[Arc]] = []
    for k in range(len(letters) + 1):
        for s in range(4):
            out: list[Arc] = []
            role, then = NEXT[s]
            if k < len(letters):
                x, down = letters[k], 4 * (k + 1)
                out.append(("D", DELETE, down + s))
                if not x.isdigit():
                    more = TRUNCATED if x.isupper() else 0
                    if x.lower() == role:
                        out.append(("K", KEEP + more, down + then))
                    elif x.lower() == "s" and s == START:
                        out.append(("K", KEEP + more, down + SYSTEM))
                    out.append(("R", REROLE + more, down + then))
            if k < len(letters) or last:
                out.append(("I", INSERT, 4 * k + then))
            if k == len(letters) and exits[s] < INF:
                out.append(("", exits[s], end))
            arcs.append(sorted(out))
    return arcs + [[]]


def auction(arcs: list[list[Arc]], price: list[int], origin: int) -> int:
    """Distance from ``origin`` to the last node, which it must reach; raises ``price`` in place."""
    end, path = len(arcs) - 1, [origin]
    while path[-1] != end:
        i = path[-1]
        best, head = min((cost + price[j], j) for _, cost, j in arcs[i])
        if price[i] < best:
            price[i] = best
            if len(path) > 1:
                path.pop()       # contraction
        else:
            path.append(head)    # extension
    return price[origin]


def _reaching(arcs: list[list[Arc]], keep) -> list[bool]:
    """Nodes with a path to the last node over the arcs that ``keep(i, arc)`` accepts."""
    ok = [False] * len(arcs)
    ok[-1] = True
    for top in range(len(arcs) - 5, -1, -4):  # the four states of a position, which inserts connect
        for _ in range(4):
            for i in range(top, top + 4):
                ok[i] = ok[i] or any(ok[a[2]] and keep(i, a) for a in arcs[i])
    return ok


@lru_cache(maxsize=1 << 14)
def block_table(letters: str) -> tuple[int, ...]:
    """Distances from each entry state (times 4) to each exit state of a block that another follows."""
    out = [INF] * 16
    for e in range(4):
        arcs = lattice(letters, tuple(0 if s == e else INF for s in range(4)), False)
        ok = _reaching(arcs, lambda i, a: True)
        arcs = [[a for a in out_i if ok[a[2]]] for out_i in arcs]
        price = [0] * len(arcs)
        for s in range(4):
            if ok[s]:
                out[4 * s + e] = auction(arcs, price, s)
    return tuple(out)


#: From each state behind the last row: nothing or a finished pair may end the form.
ACCEPT = (0, INF, INF, 0)


@lru_cache(maxsize=1 << 14)
def solve(letters: str, exits: tuple[int, ...] = ACCEPT, last: bool = True,
          entries: tuple[int, ...] = (START,)) -> tuple[tuple[int, str, int], ...]:
    """(cost, edits, exit state) for each entry state: the cheapest edits, of these the ASCII-least."""
    arcs = lattice(letters, exits, last)
    price = [0] * len(arcs)
    costs = [auction(arcs, price, s) for s in entries]
    tight = lambda i, a: price[i] == a[1] + price[a[2]]
    ok = _reaching(arcs, tight)
    out = []
    for s, cost in zip(entries, costs):
        i, edits = s, []
        while True:
            letter, _, j = next(a for a in arcs[i] if ok[a[2]] and tight(i, a))
            if j == len(arcs) - 1:
                break
            edits.append(letter)
            i = j
        out.append((cost, "".join(edits), i % 4))
    return tuple(out)


def placed(letters: str, edits: str, state: int) -> list[tuple[str, str | None, list[str], list[str]]]:
    """Per row of a block: edit letter, new role, roles inserted before it and (last row) behind it."""
    out, before = [], []
    rows = iter(letters)
    for e in edits:
        if e == "I":
            role, state = NEXT[state]
            before.append(ROLES[role])
            continue
        x, new = next(rows), None
        if e == "R":
            role, state = NEXT[state]
            new = ROLES[role]
        elif e == "K":
            state = SYSTEM if x.lower() == "s" else NEXT[state][1]
        out.append((e, new, before, []))
        before = []
    if before:
        out[-1][3].extend(before)
    return out


# ---------------------------------------------------------------- rows

def _letter() -> Column:
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return (F.when(F.col("fault").isin("blank", "duplicate"), F.translate(code, INITIALS, "0123"))
             .when(F.col("fault") == "truncated", F.upper(code)).otherwise(code))


def rows_with_faults(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                     text_col: str = "text") -> DataFrame:
    """(conv, turn, i, role, text, fault, letter): rows in their order, ``conv`` the id as text; ``fault``
    is the first of blank, duplicate and truncated that holds, or null."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    t = rows.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).alias("turn"), or_space(role_col).alias("role"),
                    or_space(text_col).alias("text"))
    t = t.withColumns({"has_turn": F.col("turn").isNotNull(), "digest": F.sha2("text", 256)})
    t = stage(series_index(t, ["conv"], ["has_turn", "turn"], tiebreak=["role", "digest"]), "repair-rows")
    again = t.groupBy("conv", "role", "digest").agg(F.min(IDX).alias("first"), F.count(F.lit(1)).alias("n"))
    again = stage(again.filter(F.col("n") > 1).select(F.col("conv").alias("f_conv"), F.col("role").alias("f_role"),
                                                      F.col("digest").alias("f_digest"), "first"), "repair-again")
    t = t.join(again, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role"))
               & (F.col("digest") == F.col("f_digest")), "left")
    bare = F.rtrim(F.translate("text", SPACE_CHARS, " "))
    fault = (F.when(bare == "", F.lit("blank")).when(F.col(IDX) > F.col("first"), F.lit("duplicate"))
              .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), F.lit("truncated")))
    t = t.select("conv", "turn", F.col(IDX).alias("i"), "role", "text", fault.alias("fault"))
    return t.withColumn("letter", _letter())


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, b, letters, n_blocks): the letters of ``block`` rows each."""
    b = F.floor(F.col("i") / block).cast("bigint").alias("b")
    t = rows.groupBy("conv", b).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "letter"))), lambda x: x["letter"]), "").alias("letters"))
    n = t.groupBy(F.col("conv").alias("n_conv")).agg(F.count(F.lit(1)).alias("n_blocks"))
    return t.join(n, F.col("conv").eqNullSafe(F.col("n_conv"))).drop("n_conv")


_SOLVED = "conv string, b long, state int, cost long, edits string, illegal long, letters string"


def _illegal(letters: str) -> int:
    x = [_initial(c) for c in letters]
    return sum(a + b not in LEGAL for a, b in zip(x, x[1:]))


def _solve_short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        got = [solve(x)[0] for x in f["letters"]]
        yield pd.DataFrame({"conv": f["conv"], "b": f["b"], "state": START, "cost": [g[0] for g in got],
                            "edits": [g[1] for g in got], "illegal": [_illegal(x) for x in f["letters"]],
                            "letters": f["letters"]})


def _tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.assign(table=[list(block_table(x)) for x in f["letters"]],
                       illegal=[_illegal(x) for x in f["letters"]], first=[_initial(x[0]) for x in f["letters"]],
                       final=[_initial(x[-1]) for x in f["letters"]])


def _exit_costs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per conversation: the cost from each state at the end of every block, and illegal pairs."""
    for f in frames:
        for conv, parts in zip(f["conv"], f["parts"]):
            parts, ends, at = list(parts), [], ACCEPT
            for part in reversed(parts):
                least = min(at)  # only differences matter to the edits, and small prices end an auction soon
                ends.append((least, [c - least for c in at]))
                at = (tuple(c for c, _, _ in solve(part["letters"], ACCEPT, True, (0, 1, 2, 3))) if len(ends) == 1 else
                      tuple(min(int(part["table"][4 * s + e]) + at[e] for e in range(4)) for s in range(4)))
            ends.reverse()
            illegal = [int(p["illegal"]) + (k > 0 and parts[k - 1]["final"] + p["first"] not in LEGAL)
                       for k, p in enumerate(parts)]
            yield pd.DataFrame({"conv": [conv] * len(parts), "b": [p["b"] for p in parts], "base": [x for x, _ in ends],
                                "exits": [x for _, x in ends], "illegal": illegal, "letters": [p["letters"] for p in parts],
                                "last": [k == len(parts) - 1 for k in range(len(parts))]})


def _solve_entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.assign(ways=[[{"cost": base + c, "edits": e, "leaves": x} for c, e, x in
                              solve(letters, tuple(int(v) for v in exits), bool(last), (0, 1, 2, 3))]
                             for letters, base, exits, last in zip(f["letters"], f["base"], f["exits"], f["last"])])[
            ["conv", "b", "letters", "illegal", "ways"]]


def _entered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per conversation: the entry state of every block."""
    for f in frames:
        for conv, parts in zip(f["conv"], f["parts"]):
            state, out = START, []
            for part in parts:
                out.append((conv, part["b"], state, part["costs"][state] if part["b"] == 0 else 0))
                state = int(part["leaves"][state])
            yield pd.DataFrame(out, columns=["conv", "b", "state", "cost"])


def solved_blocks(blocked: DataFrame) -> DataFrame:
    """(conv, b, state, cost, edits, illegal, letters): the edits of every block and the state before
    it; a conversation's cost stands on its first block, ``illegal`` adds up over the blocks."""
    short = blocked.filter("n_blocks = 1").select("conv", "b", "letters").mapInPandas(_solve_short, _SOLVED)
    long = blocked.filter("n_blocks > 1").select("conv", "b", "letters")
    t = long.mapInPandas(_tables, "conv string, b long, letters string, table array<long>, illegal long, first string, final string")
    gather = lambda df, *c: df.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("b", *c))).alias("parts"))
    t = gather(t, "letters", "table", "illegal", "first", "final").mapInPandas(
        _exit_costs, "conv string, b long, base long, exits array<long>, illegal long, letters string, last boolean")
    ways = stage(t.repartition("conv", "b").mapInPandas(
        _solve_entries, "conv string, b long, letters string, illegal long, "
                        "ways array<struct<cost:long,edits:string,leaves:int>>"), "repair-ways")
    entry = gather(ways.select("conv", "b", F.col("ways.cost").alias("costs"), F.col("ways.leaves").alias("leaves")),
                   "costs", "leaves").mapInPandas(_entered, "conv string, b long, state int, cost long")
    entry = entry.select(F.col("conv").alias("e_conv"), F.col("b").alias("e_b"), "state", "cost")
    long = ways.join(entry, F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("b") == F.col("e_b"))).select(
        "conv", "b", "state", "cost", F.get("ways", F.col("state"))["edits"].alias("edits"), "illegal", "letters")
    return short.unionByName(long)


_PLAN = "array<struct<edit:string,new_role:string,before:array<string>,behind:array<string>>>"


def _plans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield pd.DataFrame({"p_conv": f["conv"], "p_b": f["b"], "plan": [
            [{"edit": e, "new_role": r, "before": x, "behind": y} for e, r, x, y in placed(letters, edits, state)]
            for letters, edits, state in zip(f["letters"], f["edits"], f["state"])]})


def edited_rows(rows: DataFrame, solved: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` with edit, new_role, and the roles of empty turns inserted before and behind the row."""
    plans = solved.select("conv", "b", "state", "edits", "letters").mapInPandas(
        _plans, f"p_conv string, p_b long, plan {_PLAN}")
    b = F.floor(F.col("i") / block).cast("bigint")
    j = rows.join(plans, F.col("conv").eqNullSafe(F.col("p_conv")) & (b == F.col("p_b")))
    return j.select(*rows.columns, F.get("plan", (F.col("i") % block).cast("int")).alias("p")).select(*rows.columns, "p.*")


def repaired_turns(edited: DataFrame) -> DataFrame:
    """(conv, i, k, role, text): turns of the repaired conversations, in the order of (i, k)."""
    empty = lambda c: F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(
        F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))))
    return edited.select("conv", "i", F.posexplode(F.concat(empty("before"), own, empty("behind"))).alias("k", "t")).select(
        "conv", "i", "k", "t.role", "t.text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (conv, line), a conversation's in a row, to the SHA-256 of its joined lines."""
    conv, h, convs, out = None, None, [], []

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(convs, pa.string()), pa.array(out, pa.string())], names=["conv", "sha256"])
        convs.clear()
        out.clear()
        return batch

    for batch in batches:
        for c, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if h is not None and c == conv:
                h.update(b"\n")
            else:
                if h is not None:
                    convs.append(conv)
                    out.append(h.hexdigest())
                conv, h = c, hashlib.sha256()
            h.update(line)
        if len(out) >= 10_000:
            yield flush()
    if h is not None:
        convs.append(conv)
        out.append(h.hexdigest())
        yield flush()


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text`` lines joined by newlines."""
    lines = turns.select("conv", "i", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "i", "k").select("conv", "line").mapInArrow(
        _digests, "conv string, sha256 string")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(edited, solved): every row with its fault and edit, and every block of rows with its edits."""
    t = stage(rows_with_faults(rows, conv_col, turn_col, role_col, text_col), "repair-faults")
    solved = stage(solved_blocks(stage(blocks(t, block), "repair-blocks")), "repair-solved")
    return edited_rows(t, solved, block), solved


def report(convs: DataFrame, edited: DataFrame, solved: DataFrame) -> DataFrame:
    """One row per conversation of ``convs`` (conv, the id): faults, cost, audit and digest; zeros,
    no edits and the digest of nothing where it has no rows."""
    fault = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = edited.groupBy("conv").agg(F.coalesce(gaps.cast("bigint"), F.lit(0).cast("bigint")).alias("gaps"),
                                        fault("blank"), fault("duplicate"), fault("truncated"))
    audit = solved.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "edits"))), lambda x: x["edits"]), "").alias("audit"))
    out = convs
    for k, part in enumerate((counts, audit, digests(repaired_turns(edited)))):
        part = part.withColumnRenamed("conv", f"conv_{k}")
        out = out.join(part, F.col("conv").cast("string").eqNullSafe(F.col(f"conv_{k}")), "left").drop(f"conv_{k}")
    zero = F.lit(0).cast("bigint")
    return out.select("conv", *[F.coalesce(c, zero).alias(c) for c in
                                ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
