"""Best-fit packing of token pieces into fixed-size sequences.

Bounded-space online best fit: a packer keeps at most ``OPEN`` unfinished
sequences, filed by their free space, and a bitset with one bit per amount of
free space. The bin for a piece of length n is the lowest set bit at or above n
(the fullest sequence that still has room); without one a new sequence opens.
When too many are open, the fullest one closes. The stream is read through a
look-ahead of ``LOOK`` pieces, longest first, which lets short pieces fill what
long ones leave; order in the stream is kept up to that window.

Only documents longer than a sequence are cut: the remainder comes first and
the full pieces after it, so full pieces are sequences of their own and the
remainder is what has to be fitted.

The stream is cut into contiguous ranges of about ``PER_TASK`` pieces by a range
partitioning, one packer each; at most ``OPEN`` sequences per range stay
unfinished. A packer's state does not grow with its input, and a lost task
repeats its range with the same result: rows are sorted inside the range.

Defined results: a null text is an empty document (one piece, the end id); ties
in order are broken by id, piece and length, rows that still tie are alike;
repeated rows are packed as often as they occur; an empty table gives no rows;
other columns are ignored; a piece longer than the capacity or without tokens
is an error in ``pack`` (``pieces`` never makes one).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packers, stage
from .tokens import END_ID, default_tokenizer, encoder, text_batches

CAPACITY = 1024
OPEN = 8192
LOOK = 8192
PER_TASK = 200_000


class OpenBins:
    """At most ``limit`` open sequences of ``capacity`` tokens."""

    def __init__(self, capacity: int = CAPACITY, limit: int = OPEN):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``length`` tokens."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} tokens does not fit sequences of {self.capacity}")
        room = self.bits >> length << length
        if room:
            free = (room & -room).bit_length() - 1
            seq = self._take(free)
        else:
            free, seq = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(seq)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # closes the fullest
        return seq, self.capacity - free


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens, the remainder first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: Sequence[Column] = (),
           tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, order0.. [, ids]) of every
    document: token ids and the end id, cut to the capacity. ``ids`` (only with
    ``with_ids``) are little-endian unsigned 32-bit integers."""
    path = tokenizer or default_tokenizer()
    src = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(f"order{i}") for i, c in enumerate(order)],
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kept = [c for c in src.columns if c != "text"]
    schema = ", ".join([f"{c} {src.schema[c].dataType.simpleString()}" for c in kept]
                       + ["piece int, start long, length long, ids_crc32 long"] + ["ids binary"] * with_ids)
    end = np.array([END_ID], "<u4").tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for frame in frames:
            for a, b in text_batches(frame, "text"):
                row, cols = [], []
                for i, raw in enumerate(enc.encode(frame["text"].iloc[a:b].tolist()), a):
                    raw += end
                    for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                        part = raw[4 * s:4 * (s + n)]
                        row.append(i)
                        cols.append((k, s, n, zlib.crc32(part), part) if with_ids else (k, s, n, zlib.crc32(part)))
                out = pd.DataFrame(cols, columns=["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
                head = frame[kept].iloc[row].reset_index(drop=True)
                yield pd.concat([head, out], axis=1)

    return src.mapInPandas(run, schema)


def pack(parts: DataFrame, order: Sequence[str], length_col: str = "length", capacity: int = CAPACITY,
         open_bins: int = OPEN, look: int = LOOK, per_task: int = PER_TASK) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset`` (both long). ``order`` names the
    columns of the stream order. Sequence numbers are unique, grow along the
    stream and have gaps between packers. ``parts`` is staged, as counting,
    sampling for the ranges and packing read it."""
    parts = stage(parts, "pieces")
    n = packers(parts.count(), per_task)
    ordered = parts.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = parts.schema.add("sequence_id", "long").add("offset", "long")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, base, held, rows = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40, [], 0

        def place(window: pd.DataFrame) -> pd.DataFrame:
            lengths = window[length_col].to_numpy()
            put = np.zeros((len(window), 2), dtype=np.int64)
            for i in np.argsort(-lengths, kind="stable").tolist():
                put[i] = bins.place(int(lengths[i]))
            return window.assign(sequence_id=put[:, 0] + base, offset=put[:, 1])

        for frame in frames:
            held.append(frame)
            rows += len(frame)
            while rows >= look:
                window = pd.concat(held, ignore_index=True)
                yield place(window.iloc[:look])
                held, rows = [window.iloc[look:]], rows - look
        if rows:
            yield place(pd.concat(held, ignore_index=True))

    return ordered.mapInPandas(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: Sequence[Column] | None = None,
                   tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False,
                   per_task: int = PER_TASK) -> DataFrame:
    """Pieces of all documents with their place; ``order`` gives the stream
    order of documents (by default a hash of the id, which mixes them)."""
    order = [F.xxhash64(F.col(id_col))] if order is None else list(order)
    names = [f"order{i}" for i in range(len(order))]
    out = pack(pieces(docs, id_col, text_col, order, tokenizer, capacity, with_ids),
               [*names, "doc_id", "piece", "length"], capacity=capacity, per_task=per_task)
    return out.drop(*names)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences from ``pack_documents``
    with ``with_ids``; a group is one sequence, at most its capacity."""
    join = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.reduce(join, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
