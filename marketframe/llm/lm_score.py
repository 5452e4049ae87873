"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ``ORDER`` bytes. A byte's probability
comes from the longest context seen in training; where it did not follow that context,
the model escapes to the context one byte shorter, and so on down to a uniform
choice among the bytes that no context has. Method D estimates the escape: a context
with N occurrences of q different next bytes gives (2n - 1) / 2N to a byte seen n
times and q / 2N to the escape. Bytes seen in a longer context are excluded from
the shorter one after an escape. Byte 0xFF, which UTF-8 never has, stands
before the text and ends it; a text's code length covers its bytes and the end.

How it is computed: a byte's probability depends only on the window of it and the
``ORDER`` bytes before, which fits a 64-bit integer. Documents are dealt by hash into
groups of about ``GROUP_CHARS`` characters.

1. Each group counts its distinct windows and words; (window, count, group) rows are
   summed by window. This is the whole trie: shorter contexts are suffix sums.
2. Trie nodes of each order are (context -> next bytes with counts), at most 256
   entries, joined to their suffix for the excluded mass. Windows seen in training
   need their own context only; the rest walk down one order per join.
3. Probabilities go back to the groups that asked, where each document looks up its
   windows. Traffic is per distinct window and group, not per byte, and grows with the
   corpus; nothing is broadcast but the nodes of order 0 and 1 (257 at most).

Words for the base score (unigrams) take the same way. Words are matched by their
full text.

Defined results: a null text is empty and scores its end alone; an empty table gives no
rows; without training documents every byte is uniform over 256 and the base has
N = V = 0; rows with a null id hash as empty text; repeated rows are learned
and scored as often as they occur; very long texts are whole, their windows are made
in pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packers, stage, unstage

ORDER = 5
GROUP_CHARS = 16_000_000
EDGE = 0xFF
_CHUNK = 1_000_000
_SLICE = 100_000
_ONE = np.uint64(8)


def windows(text: bytes, order: int = ORDER) -> Iterator[np.ndarray]:
    """Windows of ``order`` bytes and the byte after them, for each byte of the text
    and its end, as integers; in arrays of bounded size."""
    data = bytes([EDGE]) * order + text + bytes([EDGE])
    for k in range(0, len(data) - order, _CHUNK):
        raw = np.frombuffer(data[k:k + _CHUNK + order], np.uint8).astype(np.uint64)
        n = len(raw) - order
        w = np.zeros(n, np.uint64)
        for j in range(order + 1):
            w = (w << _ONE) | raw[j:j + n]
        yield w


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words and one end."""
    return [*text.lower().split(), b""]


class _Tally:
    """Distinct windows of texts, in ascending order, and their counts; texts may be added in parts."""

    def __init__(self, order: int):
        self.order, self.keys, self.n = order, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.raw: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.raw_size = self.held_size = 0

    def add(self, text: bytes) -> None:
        for w in windows(text, self.order):
            self.raw.append(w)
            self.raw_size += len(w)
            if self.raw_size >= _CHUNK:
                self._count()

    def _count(self) -> None:
        if self.raw:
            self.held.append(np.unique(np.concatenate(self.raw), return_counts=True))
            self.held_size += len(self.held[-1][0])
            self.raw, self.raw_size = [], 0
        if self.held_size > _CHUNK:
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *[u for u, _ in self.held]])
        n = np.concatenate([self.n, *[c for _, c in self.held]])
        self.held, self.held_size = [], 0
        place = np.argsort(keys, kind="stable")  # of sorted runs
        keys, n = keys[place], n[place]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else place
        self.keys, self.n = keys[first], np.add.reduceat(n, first) if len(keys) else n

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._count()
        if self.held:
            self._merge()
        return self.keys, self.n


def _without(keys: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Keys that are not in ``other``, both ascending and distinct."""
    if not len(other):
        return keys
    at = np.minimum(np.searchsorted(other, keys), len(other) - 1)
    return keys[other[at] != keys]


def _group_counts(order: int):
    """Texts come in batches and rows leave in slices, so a task holds the distinct windows
    and words of a group but neither its texts nor a frame of all its rows."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learn, test = _Tally(order), _Tally(order)
        count: Counter[bytes] = Counter()
        grp = 0
        for frame in frames:
            for grp, held, value in zip(frame["grp"], frame["held_out"], frame["text"]):
                text = value.encode("utf-8")
                (test if held else learn).add(text)
                if held:
                    for w in words(text):
                        count.setdefault(w, 0)
                else:
                    count.update(words(text))
            del frame
        # windows first (word null), then words (win not used)
        u, n = learn.result()
        new = _without(test.result()[0], u)
        del learn, test
        for keys, times in ((u, n), (new, np.zeros(len(new), np.int64))):
            for k in range(0, len(keys), _SLICE):
                part = keys[k:k + _SLICE].view(np.int64)
                yield pd.DataFrame({"grp": grp, "win": part, "word": np.full(len(part), None, object),
                                    "n": times[k:k + _SLICE]})
        items = iter(count.items())
        while some := list(islice(items, _SLICE)):
            yield pd.DataFrame({"grp": grp, "win": np.zeros(len(some), np.int64),
                                "word": [w.decode("utf-8") for w, _ in some], "n": [c for _, c in some]})

    return run


# ------------------------------------------------------------------ trie nodes

def _nodes(counts: DataFrame) -> DataFrame:
    """(ctx, total, kinds, next): a row per context; ``next`` maps its next bytes
    (256 at most) to counts. ``counts`` has (win, n)."""
    ctx, byte = F.shiftright("win", 8), F.col("win").bitwiseAND(F.lit(255)).cast("int")
    return counts.groupBy(ctx.alias("ctx")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"),
        F.map_from_entries(F.collect_list(F.struct(byte.alias("b"), "n"))).alias("next"))


def trie(counts: DataFrame, order: int) -> list[DataFrame]:
    """Nodes of the orders 0 to ``order`` with ``over``: the mass that the next bytes of
    a context have in the context one byte shorter, excluded after an escape from it."""
    out: list[DataFrame] = []
    per_order = [counts]
    for k in range(order - 1, -1, -1):
        mask = F.lit((1 << 8 * (k + 1)) - 1)
        short = per_order[0].groupBy(F.col("win").bitwiseAND(mask).alias("win")).agg(F.sum("n").alias("n"))
        per_order.insert(0, stage(short, f"trie-counts-{k}"))
    for k, c in enumerate(per_order):
        nodes = _nodes(c)
        if k == 0:
            nodes = nodes.withColumn("over", F.lit(0).cast("long"))
        else:
            up = out[-1].select(F.col("ctx").alias("up_ctx"), F.col("next").alias("up_next"))
            up = F.broadcast(up) if k <= 2 else up  # order 0 and 1: 257 contexts at most
            suffix = F.col("ctx").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            over = F.aggregate(F.map_keys("next"), F.lit(0).cast("long"),
                               lambda a, b: a + F.element_at(F.col("up_next"), b))
            nodes = nodes.join(up, suffix == F.col("up_ctx")).select("ctx", "total", "kinds", "next", over.alias("over"))
        out.append(stage(nodes, f"trie-nodes-{k}"))
    return out


def window_scores(asked: DataFrame, nodes: list[DataFrame], order: int) -> DataFrame:
    """(win, lp): log10 probability of each distinct window of ``asked`` (win, n),
    n its training count."""
    full = 8 * (order + 1)
    top = nodes[order].select("ctx", "total", "kinds")
    seen = (asked.filter("n > 0").withColumn("ctx", F.shiftright("win", 8)).join(top, "ctx")
                 .select("win", F.log10((F.lit(2) * F.col("n") - 1) / (F.lit(2.0) * F.col("total"))).alias("lp")))
    zero = F.lit(0).cast("long")
    rest = asked.filter("n = 0").select("win", F.lit(0.0).alias("lp"), F.lit(False).alias("done"),
                                        zero.alias("over"), zero.alias("gone"))
    for k in range(order, -1, -1):
        node = nodes[k].select("ctx", "total", "kinds", "next", F.col("over").alias("next_over"))
        node = F.broadcast(node) if k <= 1 else node  # 257 contexts at most
        ctx = F.shiftright(F.col("win").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1 if k < order else (1 << full) - 1)), 8)
        j = rest.withColumn("at", ctx).join(node, F.col("at") == F.col("ctx"), "left")
        byte = F.col("win").bitwiseAND(F.lit(255)).cast("int")
        n = F.try_element_at("next", byte)
        left, kinds = F.col("total") - F.col("over"), F.col("kinds") - F.col("gone")  # without excluded bytes
        size = F.lit(2.0) * left
        open_ = ~F.col("done") & F.col("ctx").isNotNull()
        hit = open_ & n.isNotNull()
        lp = (F.when(hit, F.col("lp") + F.log10((F.lit(2) * n - 1) / size))
               .when(open_ & (kinds > 0), F.col("lp") + F.log10(kinds / size)).otherwise(F.col("lp")))
        rest = j.select("win", lp.alias("lp"), (F.col("done") | F.coalesce(hit, F.lit(False))).alias("done"),
                        F.coalesce("next_over", F.lit(0)).alias("over"), F.coalesce("kinds", F.lit(0)).alias("gone"))
        if k >= 2:
            rest = stage(rest, f"walk-{k}")
    uniform = F.log10(F.lit(1.0) / (F.lit(256) - F.col("gone")))
    rest = rest.select("win", F.when(F.col("done"), F.col("lp")).otherwise(F.col("lp") + uniform).alias("lp"))
    return seen.unionByName(rest)


# ------------------------------------------------------------------ scoring

class Lookup:
    """Values by 64-bit key, all of which are known to be there: keys in order of a
    multiplicative hash, reached through the first place of each hash value."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 over the golden ratio, odd

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        h = self._hash(keys)
        place = np.argsort(h, kind="stable")
        self.keys, self.values = keys[place], values[place]
        count = np.bincount(h, minlength=1 << bits)
        self.first = (np.cumsum(count) - count).astype(np.int32)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._FACTOR) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.first[self._hash(keys)]
        todo = np.flatnonzero(self.keys[at] != keys)
        while len(todo):
            at[todo] += 1
            todo = todo[self.keys[at[todo]] != keys[todo]]
        return self.values[at]


# Kinds of rows that a group gets for its scores.
_DOC, _WINDOW, _KNOWN, _UNKNOWN = range(4)


def _score_group(order: int):
    """A group's texts, windows and words come in batches, in any order; kept are its texts as bytes, two
    numbers a window and an entry a word, and rows leave in slices."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs: list[tuple] = []
        index: dict[bytes, int] = {}
        keys, values, term, known = [], [], [], []
        for frame in frames:
            kind, text = frame["kind"].to_numpy(), frame["text"].to_numpy()
            win, val = frame["win"].to_numpy(np.int64), frame["val"].to_numpy(float)
            is_doc, is_win = kind == _DOC, kind == _WINDOW
            keys.append(win[is_win].view(np.uint64))
            values.append(val[is_win])
            is_word = ~(is_doc | is_win)
            index.update((w.encode("utf-8"), i) for i, w in enumerate(text[is_word], len(index)))
            term.append(val[is_word])
            known.append(kind[is_word] == _KNOWN)
            docs += zip(frame["doc_id"].to_numpy()[is_doc], win[is_doc], (t.encode("utf-8") for t in text[is_doc]))
            del frame, text, kind, win, val
        if not docs:
            return
        lp = Lookup(np.concatenate(keys), np.concatenate(values))
        del keys, values
        terms, knowns = np.concatenate(term), np.concatenate(known)
        for k in range(0, len(docs), _SLICE):
            rows = []
            for doc_id, held, raw in docs[k:k + _SLICE]:
                score = sum(float(lp.get(w).sum()) for w in windows(raw, order))
                toks = words(raw)
                at = np.fromiter(map(index.__getitem__, toks), np.int64, len(toks))
                rows.append((doc_id, held, len(toks), int(knowns[at].sum()), float(terms[at].sum()), score))
            yield pd.DataFrame(rows, columns=["doc_id", "held", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          group_chars: int = GROUP_CHARS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row; the model learns from the rows that are not ``held_out``."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6 bytes")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    chars = src.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    groups = packers(int(chars), group_chars)
    src = src.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))

    asked = src.groupBy("grp").applyInPandas(_group_counts(order), "grp int, win long, word string, n long")
    asked = stage(asked, "group-counts")
    by_win = stage(asked.filter("word is null").groupBy("win").agg(
        F.sum("n").alias("n"), F.collect_list("grp").alias("grps")), "windows")  # a list has one entry a group
    by_word = stage(asked.filter("word is not null").groupBy("word").agg(
        F.sum("n").alias("n"), F.collect_list("grp").alias("grps")), "words")
    unstage(asked)  # the two tables hold all of it
    n, v = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()

    counts = by_win.filter("n > 0").select("win", "n")
    lps = stage(window_scores(by_win.select("win", "n"), trie(counts, order), order), "window-scores")
    den = math.log10(n + 0.5 * (v + 1))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("string")
    # Texts, windows and words of a group are rows of one frame, which comes in batches (a cogroup hands over both
    # sides whole). Ids go as text: whole numbers beside nulls would turn into floating ones.
    no_id, no_val = none.alias("doc_id"), F.lit(0.0).alias("val")
    held = F.coalesce(F.col("held_out").cast("long"), F.lit(-1).cast("long")).alias("win")
    rows = (src.select("grp", F.lit(_DOC).alias("kind"), F.col("doc_id").cast("string").alias("doc_id"), "text", held, no_val)
            .unionByName(by_win.join(lps, "win").select(
                F.explode("grps").alias("grp"), F.lit(_WINDOW).alias("kind"), no_id, none.alias("text"), "win", F.col("lp").alias("val")))
            .unionByName(by_word.select(
                F.explode("grps").alias("grp"), F.when(F.col("n") > 0, _KNOWN).otherwise(_UNKNOWN).alias("kind"), no_id,
                F.col("word").alias("text"), zero.alias("win"), (F.log10(F.col("n") + 0.5) - F.lit(den)).alias("val"))))
    out = rows.groupBy("grp").applyInPandas(
        _score_group(order), "doc_id string, held long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("doc_id").cast(src.schema["doc_id"].dataType).alias("doc_id"),
                      F.when(F.col("held") >= 0, F.col("held") == 1).alias("held_out"), "n_tokens", "n_known",
                      F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
