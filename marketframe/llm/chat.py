"""Chat formatting: roles of transcript lines by a hidden Markov model, then turns.

A line is observed as one symbol: its speaker marker (user, assistant, system, another
name, none; see ``marker``) and its shape (blank, question, short, long). The states are
role x (first line of a turn, later line). Parameters are smoothed counts over
labelled lines; the Viterbi path gives each line its role, and a first-line state
starts a turn. Turns are rendered in one canonical form without their markers.

Long transcripts are decoded exactly in blocks of ``BLOCK`` lines. A block is the
max-plus matrix of best scores from the state before it to the state at its end;
a scan over a transcript's matrices gives the states at block ends (in levels of
``FAN``, so that no task holds more than ``FAN`` matrices of a transcript); then each
block is decoded between its fixed ends. A transcript with a third of all
lines is thus many small tasks.

Defined results: a null line is blank; null transcript ids are one transcript; lines
with the same order are taken by their text, and alike lines in any order; an empty
table gives no rows; without labelled lines all parameters are equal and ties
go to the first state in the order of ``ROLES``; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.series import IDX, series_index
from .common import stage

# Roles, and the speaker names that stand for them.
ROLES = ("system", "user", "assistant")
NAMES = {
    "user": "user|human|customer|prompter|question|q",
    "assistant": "assistant|ai|bot|chatbot|model|agent|answer|a",
    "system": "system|developer|instructions?",
}
MARKERS = ("none", "user", "assistant", "system", "name")
SHAPES = ("blank", "question", "short", "long")
SHORT = 80
STATES = 2 * len(ROLES)  # 2r: first line of a turn of role r, 2r + 1: later line
SYMBOLS = len(MARKERS) * len(SHAPES)
BLOCK = 4096
FAN = 4096


def _pattern(names: str) -> str:
    return rf"(?i)^\s*(?:[#*>-]*\s*(?:{names})\s*\**\s*:\**|<\|?(?:{names})\|?>:?|\[(?:{names})\]:?)\s*"


_OTHER = r"^\s*[A-Z][\w.-]*(?: [A-Z][\w.-]*){0,2}:\s"


def marker(line: Column) -> Column:
    """Index in ``MARKERS`` of the speaker marker that a line starts with."""
    out = F.when(line.rlike(_pattern(NAMES["user"])), 1)
    for i in (2, 3):
        out = out.when(line.rlike(_pattern(NAMES[MARKERS[i]])), i)
    return out.when(line.rlike(_OTHER), 4).otherwise(0)


def symbol(line: Column) -> Column:
    """The observed symbol of a line."""
    bare = F.trim(line)
    shape = F.when(bare == "", 0).when(bare.endswith("?"), 1).when(F.length(bare) < SHORT, 2).otherwise(3)
    return (marker(line) * len(SHAPES) + shape).cast("int")


def unmarked(line: Column) -> Column:
    """A line without the speaker marker that ``marker`` found; what follows it stays, a marker too."""
    out = line
    for name in reversed(MARKERS[1:4]):  # the first that matches is taken
        out = F.when(line.rlike(_pattern(NAMES[name])), F.regexp_replace(line, _pattern(NAMES[name]), "")).otherwise(out)
    return out


def role_index(role: Column) -> Column:
    out = F.when(role == ROLES[0], 0)
    for i, r in enumerate(ROLES[1:], 1):
        out = out.when(role == r, i)
    return out


class Model:
    """Log probabilities of starts, steps and symbols."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        def log(x: np.ndarray) -> np.ndarray:
            x = x + 1.0  # one added to each count
            return np.log(x / x.sum(axis=-1, keepdims=True))

        self.start, self.step, self.emit = log(start), log(step), log(emit)
        first = np.arange(STATES) % 2 == 0
        # a transcript starts with a first line; a later line follows a line of its role
        self.start[~first] = -math.inf
        for s in range(STATES):
            for t in range(STATES):
                if not first[t] and s // 2 != t // 2:
                    self.step[s, t] = -math.inf

    def moves(self, symbols: np.ndarray, opening: bool) -> np.ndarray:
        """Scores (n, from, to) of each line; in an opening block the state before
        the first line does not matter."""
        out = self.step[None] + self.emit[:, symbols].T[:, None, :]
        if opening:
            out[0] = self.start[None] + self.emit[:, symbols[0]][None]
        return out


def fit(lines: DataFrame) -> Model:
    """Counts over labelled lines (``state``, ``before``: state of the line before,
    null at the start, ``symbol``); three small grouped counts."""
    n = F.count(F.lit(1)).alias("n")
    start, step, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, SYMBOLS))
    for r in lines.groupBy("before", "state").agg(n).collect():  # at most 7 x 6 rows
        if r["before"] is None:
            start[r["state"]] += r["n"]
        else:
            step[r["before"], r["state"]] += r["n"]
    for r in lines.groupBy("state", "symbol").agg(n).collect():  # at most 6 x 20 rows
        emit[r["state"], r["symbol"]] += r["n"]
    return Model(start, step, emit)


# ------------------------------------------------------------------ Viterbi in blocks

def chain(moves: np.ndarray) -> np.ndarray:
    """Max-plus product of (n, from, to) scores."""
    out = moves[0]
    for m in moves[1:]:
        out = (out[:, :, None] + m[None]).max(axis=1)
    return out


def best_path(moves: np.ndarray, enter: int, leave: int | None) -> list[int]:
    """States after each step of the best path from state ``enter`` (to ``leave``,
    or to the best end); ties go to the smaller state."""
    score, back = moves[0][enter], []
    for m in moves[1:]:
        ways = score[:, None] + m
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    state = int(score.argmax()) if leave is None else leave
    path = [state]
    for b in reversed(back):
        state = int(b[state])
        path.append(state)
    return path[::-1]


def _by_group(keys: Sequence[str], work, columns: list[str]):
    """Runs ``work(frame)`` on each whole group of rows sorted by ``keys``; the last group
    of a frame waits for the next frame. Groups must be of bounded size."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            new = np.zeros(len(frame), bool)
            for k in keys:
                v, p = frame[k], frame[k].shift()
                new |= ~((v == p) | (v.isna() & p.isna())).to_numpy(bool)
            new[0] = True
            at = np.flatnonzero(new)
            done = [work(frame.iloc[a:b]) for a, b in zip(at[:-1], at[1:])]
            if done:
                yield pd.concat(done, ignore_index=True)[columns]
            held = frame.iloc[at[-1]:]
        if held is not None and len(held):
            yield work(held)[columns]

    return run


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def _tensor(frame: pd.DataFrame) -> np.ndarray:
    return np.stack([np.asarray(m, float).reshape(STATES, STATES) for m in frame["m"]])


def _ends(mats: DataFrame, fan: int) -> DataFrame:
    """(conv, block, enter, leave): states around each block on the best path."""
    kind = mats.schema["conv"].dataType.simpleString()

    def solve(frame: pd.DataFrame, enter: int = 0, leave: int | None = None) -> pd.DataFrame:
        path = best_path(_tensor(frame), enter, leave)
        return pd.DataFrame({"conv": frame["conv"].to_numpy(), "block": frame["block"].to_numpy(),
                             "enter": [enter, *path[:-1]], "leave": path})

    top = mats.agg(F.max("block")).first()[0]
    names, schema = ["conv", "block", "enter", "leave"], f"conv {kind}, block long, enter int, leave int"
    if top is None or top < fan:
        return _dealt(mats, ["conv"], ["block"]).mapInPandas(_by_group(["conv"], solve, names), schema)
    up = mats.withColumn("up", F.floor(F.col("block") / F.lit(fan)).cast("long"))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"conv": frame["conv"].iloc[:1].to_numpy(), "block": frame["up"].iloc[:1].to_numpy(),
                             "m": [chain(_tensor(frame)).ravel()]})

    merged = _dealt(up, ["conv", "up"], ["block"]).mapInPandas(
        _by_group(["conv", "up"], merge, ["conv", "block", "m"]), f"conv {kind}, block long, m array<double>")
    around = _ends(stage(merged, "viterbi-level"), fan).select(
        F.col("conv").alias("c2"), F.col("block").alias("b2"), F.col("enter").alias("e2"), F.col("leave").alias("l2"))
    j = up.join(around, up["conv"].eqNullSafe(around["c2"]) & (up["up"] == around["b2"])).drop("c2", "b2")
    inner = lambda f: solve(f, int(f["e2"].iloc[0]), int(f["l2"].iloc[0]))
    return _dealt(j, ["conv", "up"], ["block"]).mapInPandas(_by_group(["conv", "up"], inner, names), schema)


def decode(lines: DataFrame, model: Model, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """``lines`` (conv, pos: dense from 0, symbol) with ``state`` of the best path. Should be staged."""
    kind = lines.schema["conv"].dataType.simpleString()
    rows = lines.select("conv", F.floor(F.col("pos") / F.lit(block)).cast("long").alias("block"), "pos", "symbol")

    def matrix(frame: pd.DataFrame) -> pd.DataFrame:
        b = int(frame["block"].iloc[0])
        return pd.DataFrame({"conv": frame["conv"].iloc[:1].to_numpy(), "block": [b],
                             "m": [chain(model.moves(frame["symbol"].to_numpy(), b == 0)).ravel()]})

    def path(frame: pd.DataFrame) -> pd.DataFrame:
        moves = model.moves(frame["symbol"].to_numpy(), int(frame["block"].iloc[0]) == 0)
        leave = frame["leave"].iloc[0]
        return pd.DataFrame({"conv": frame["conv"].to_numpy(), "pos": frame["pos"].to_numpy(),
                             "state": best_path(moves, 0 if pd.isna(leave) else int(frame["enter"].iloc[0]),
                                                None if pd.isna(leave) else int(leave))})

    # only transcripts of more than one block need matrices
    more = rows.filter(F.col("block") > 0).select(F.col("conv").alias("long_conv")).distinct()
    long = rows.join(more, rows["conv"].eqNullSafe(more["long_conv"]), "left_semi")
    mats = stage(_dealt(long, ["conv", "block"], ["pos"]).mapInPandas(
        _by_group(["conv", "block"], matrix, ["conv", "block", "m"]), f"conv {kind}, block long, m array<double>"),
        "viterbi-blocks")
    ends = stage(_ends(mats, fan), "viterbi-ends").select(F.col("conv").alias("e_conv"), F.col("block").alias("e_block"),
                                                         "enter", "leave")
    j = rows.join(ends, rows["conv"].eqNullSafe(ends["e_conv"]) & (rows["block"] == ends["e_block"]), "left")
    j = j.select("conv", "block", "pos", "symbol", "enter", "leave")
    return _dealt(j, ["conv", "block"], ["pos"]).mapInPandas(
        _by_group(["conv", "block"], path, ["conv", "pos", "state"]), f"conv {kind}, pos long, state int")


# ------------------------------------------------------------------ turns

def parse(lines: DataFrame, model: Model, conv_col: str = "conv_id", order: Sequence[str] = ("line_no",),
          text_col: str = "text", block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(conv_id, pos, turn, role, text): every line of the transcripts with its
    recovered role and the number of its turn, from 0."""
    named = lines.select(F.col(conv_col).alias("conv"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    placed = series_index(named, keys=["conv"], order=[f"o{i}" for i in range(len(order))], tiebreak=["text"])
    placed = stage(placed.select("conv", F.col(IDX).cast("long").alias("pos"), "text", symbol(F.col("text")).alias("symbol")),
                   "chat-lines")
    states = stage(decode(placed, model, block, fan), "chat-states").withColumn("b", F.floor(F.col("pos") / F.lit(block)))
    first = (F.col("state") % 2 == 0).cast("long")
    # turns begun before a line: in its block, plus those of earlier blocks
    here = F.sum(first).over(Window.partitionBy("conv", "b").orderBy("pos"))
    begun = states.groupBy(F.col("conv").alias("c2"), F.col("b").alias("b2")).agg(F.sum(first).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c2").orderBy("b2").rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.select("c2", "b2", F.coalesce(before, F.lit(0)).alias("before"))
    t = states.withColumn("here", here)
    t = t.join(begun, t["conv"].eqNullSafe(begun["c2"]) & (t["b"] == begun["b2"])).select(
        F.col("conv").alias("c3"), F.col("pos").alias("p3"), "state", (F.col("before") + F.col("here") - 1).alias("turn"))
    j = placed.join(t, placed["conv"].eqNullSafe(t["c3"]) & (placed["pos"] == t["p3"]))
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), (F.floor(F.col("state") / 2) + 1).cast("int"))
    own = F.when(F.col("state") % 2 == 0, unmarked(F.col("text"))).otherwise(F.col("text"))
    return j.select(F.col("conv").alias("conv_id"), "pos", "turn", role.alias("role"), own.alias("text"))


def turns(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, role, n_lines, text, rendered): one row per turn, its lines
    joined again; ``rendered`` is the canonical form."""
    t = parsed.groupBy("conv_id", "turn").agg(
        F.min("role").alias("role"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return t.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")))


def labelled(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", line_col: str = "line",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(state, before, symbol) of lines with a known role, for ``fit``. Lines are numbered
    from 0 in each turn. The state before a turn's first line is that of the last line of
    the turn numbered one lower, found by an equality join. Lines with another role are left out."""
    r = role_index(F.col(role_col))
    t = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(line_col).alias("line"),
                    r.alias("r"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).filter("r is not null")
    last = t.groupBy("conv", "turn").agg(F.max(F.struct("line", "r")).alias("z")).select(
        F.col("conv").alias("c2"), (F.col("turn") + 1).alias("t2"),
        (F.col("z.r") * 2 + F.when(F.col("z.line") > 0, 1).otherwise(0)).alias("from_turn"))
    j = t.join(last, t["conv"].eqNullSafe(last["c2"]) & (t["turn"] == last["t2"]), "left")
    inside = F.col("r") * 2 + F.when(F.col("line") > 1, 1).otherwise(0)
    return j.select((F.col("r") * 2 + F.when(F.col("line") > 0, 1).otherwise(0)).alias("state"),
                    F.when(F.col("line") > 0, inside).otherwise(F.col("from_turn")).alias("before"),
                    symbol(F.col("text")).alias("symbol"))
