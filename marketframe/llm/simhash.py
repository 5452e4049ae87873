"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits, one per bit position of the XXH64 hashes of a text's
word shingles (majority over all shingles, repeats included). Two fingerprints that
differ in at most ``d`` bits agree on at least one of ``d + 1`` blocks, so distinct
fingerprints are joined on blocks and each bucket is verified by Hamming
distance.

* Equal fingerprints are one node, so copies are never compared.
* A bucket larger than ``LIMIT`` is split again: its unused bits are cut into
  ``d + 1`` smaller blocks, of which a linked pair must share one too. That goes
  on until buckets are small or at most ``FREE_BITS`` bits are left, which bounds
  a bucket by itself, and loses no link.
* Verification runs over buckets in sorted partitions and emits a spanning
  forest of a bucket's links, never more rows than it has members.
* Links go to connected components; each document gets the smallest id of its
  component.

Defined results: null and empty texts have no words and the fingerprint zero,
which is linked like any other; a null id never names a component that has
another id; ``drop_near`` decides by row, so an id repeated on other texts, or none, makes no
difference to what is kept of a component; very long texts are read whole, in a batch of
their own; an empty table gives no rows; other columns are ignored by ``near_duplicates`` and returned
unchanged by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import components
from .tokens import text_batches

SHINGLE = 3
DISTANCE = 3
SEED = 42
LIMIT = 4096
#: A bucket whose mask leaves so few bits free has 2 ** FREE_BITS members at most.
FREE_BITS = 15
_CHUNK = 1 << 16
_M64 = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint as an unsigned integer."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    begin, end = begin[:len(words) - shingle + 1], end[shingle - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(begin), _CHUNK):
        at = zip(begin[k:k + _CHUNK].tolist(), end[k:k + _CHUNK].tolist())
        h = np.array([digest(joined[a:b], seed) for a, b in at], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(begin), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED, key: Column | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit integer; with
    ``key`` (binary) a third column of that name."""
    src = docs.select(F.col(id_col).alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      *([] if key is None else [key.alias("key")]))
    more = [] if key is None else ["key"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in text_batches(frame, "text"):
                part = frame.iloc[a:b]
                fp = np.array([fingerprint(t, shingle, seed) for t in part["text"]], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "fp": fp, **{c: part[c].to_numpy() for c in more}})

    kinds = "".join(f", {c} binary" for c in more)
    return src.mapInPandas(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long{kinds}")


# ------------------------------------------------------------------ candidate buckets

def cut_bits(free: tuple[int, ...], parts: int) -> list[tuple[int, ...]]:
    """``free`` bit positions cut into ``parts`` runs of about equal length."""
    return [tuple(int(x) for x in run) for run in np.array_split(np.array(free, dtype=int), parts)]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _level(rows: DataFrame, shapes: dict[int, tuple[int, ...]], parts: int) -> tuple[DataFrame, dict[int, tuple[int, ...]]]:
    """Rows (mask, fp) go to one row (mask, fp) per block of the bits that their
    mask leaves free; a bucket is a mask with the fingerprint's bits under it.
    ``shapes`` holds the free bits of each mask."""
    after: dict[int, tuple[int, ...]] = {}
    choices = []
    for mask, free in shapes.items():
        arr = []
        for block in cut_bits(free, parts):
            m = _mask([b for b in range(64) if b not in free or b in block])
            after[m] = tuple(b for b in free if b not in block)
            arr.append(F.lit(m).cast("long"))
        choices.append((mask, F.array(*arr)))
    pick = F.when(F.col("mask") == F.lit(choices[0][0]).cast("long"), choices[0][1])
    for mask, arr in choices[1:]:
        pick = pick.when(F.col("mask") == F.lit(mask).cast("long"), arr)
    out = rows.select("fp", F.explode(pick).alias("mask"))
    return out.select("mask", "fp"), after


def _links(distance: int):
    """Spanning forests of the links within buckets. Frames arrive sorted by
    bucket; the last, maybe unfinished bucket waits for the next frame."""
    def forest(mask: np.ndarray, fp: np.ndarray) -> np.ndarray:
        key = fp & mask
        n = len(fp)
        run = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
        last = np.repeat(np.r_[run[1:], n], np.diff(np.r_[run, n]))  # end of each row's bucket
        root, out = np.arange(n), []
        at, step = np.arange(n), 1
        while len(at):
            at = at[at + step < last[at]]
            near = np.bitwise_count(fp[at] ^ fp[at + step]) <= distance
            a, b = at[near], at[near] + step
            new = root[a] != root[b]
            a, b = a[new], b[new]
            while len(a):  # one union per root at a time, then shorten the paths
                lo, hi = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
                _, first = np.unique(hi, return_index=True)
                root[hi[first]] = lo[first]
                out.append(np.stack([fp[a[first]], fp[b[first]]], axis=1))
                while (root[root] != root).any():
                    root = root[root]
                rest = root[a] != root[b]
                a, b = a[rest], b[rest]
            step += 1
        return np.concatenate(out) if out else np.empty((0, 2), np.uint64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            mask, fp = frame["mask"].to_numpy().astype(np.uint64), frame["fp"].to_numpy().astype(np.uint64)
            if held is not None:
                mask, fp = np.r_[held[0], mask], np.r_[held[1], fp]
            if not len(fp):
                continue
            own = (mask == mask[-1]) & (fp & mask == fp[-1] & mask[-1])
            held = mask[own], fp[own]
            e = forest(mask[~own], fp[~own]).astype(np.int64)
            yield pd.DataFrame({"u": e[:, 0], "v": e[:, 1]})
        if held is not None:
            e = forest(*held).astype(np.int64)
            yield pd.DataFrame({"u": e[:, 0], "v": e[:, 1]})

    return run


def link_fingerprints(nodes: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """(u, v): links that span the components of distinct fingerprints ``fp``
    within ``distance`` bits. ``nodes`` should be staged."""
    found = None
    rows, shapes = nodes.select("fp", F.lit(0).cast("long").alias("mask")), {0: tuple(range(64))}
    while True:
        rows, shapes = _level(rows, shapes, distance + 1)
        rows = rows.withColumn("bucket", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stage(rows.groupBy("mask", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
        final = all(len(free) <= FREE_BITS for free in shapes.values())
        small = sizes if final else sizes.filter(F.col("n") <= limit)
        ready = rows.join(small.select("mask", "bucket"), ["mask", "bucket"], "left_semi").select("mask", "bucket", "fp")
        links = stage(ready.repartition("mask", "bucket").sortWithinPartitions("mask", "bucket", "fp")
                           .select("mask", "fp").mapInPandas(_links(distance), "u long, v long"), "links")
        found = links if found is None else found.unionByName(links)
        large = sizes.filter(F.col("n") > limit)
        if final or large.isEmpty():
            return found
        alive = {r["mask"] for r in large.select("mask").distinct().collect()}  # one integer per block choice
        shapes = {m: free for m, free in shapes.items() if m in alive}
        rows = stage(rows.join(large.select("mask", "bucket"), ["mask", "bucket"], "left_semi")
                         .select("fp", "mask"), "large-buckets")


def _lowest(rows: DataFrame, low: Column, distance: int, limit: int) -> DataFrame:
    """(node_fp, low): the smallest ``low`` of the component of each distinct fingerprint."""
    nodes = stage(rows.groupBy("fp").agg(F.min(low).alias("low")), "nodes")
    comp = components(link_fingerprints(nodes, distance, limit))
    rooted = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        nodes["fp"], "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
    return rooted.drop("low").join(lowest, "root").select(F.col("fp").alias("node_fp"), "low")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, seed: int = SEED, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed 64-bit fingerprint) and
    component_id, the smallest doc_id reachable over links, itself included."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    by_fp = _lowest(rows, F.col("doc_id"), distance, limit)
    return rows.join(by_fp, rows["fp"] == by_fp["node_fp"]).select("doc_id", "fp", F.col("low").alias("component_id"))


def hex_fingerprint(fp: str = "fp"):
    """16 lower-case hex digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _row_key(docs: DataFrame, text_col: str) -> Column:
    """16 bytes of a SHA-256 of the whole row: the same whenever the row is read or
    computed again. Rows that share it are alike in every column."""
    text = F.coalesce(F.sha2(F.col(text_col).cast("string").cast("binary"), 256), F.lit(""))
    rest = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != text_col]))
    return F.substring(F.unhex(F.sha2(F.concat_ws(" ", text, rest), 256)), 1, 16)


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
              distance: int = DISTANCE, seed: int = SEED, limit: int = LIMIT) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id. Rows
    without an id come after all others; of rows that share the id, the smallest
    fingerprint and then row key stays, so an id on different texts can stay on several rows."""
    key = _row_key(docs, text_col)
    rows = stage(fingerprints(docs, id_col, text_col, shingle, seed, key), "fingerprints")
    by_fp = _lowest(rows, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "key"), distance, limit)
    near = stage(rows.join(by_fp, rows["fp"] == by_fp["node_fp"])
                     .select("key", (F.col("key") == F.col("low.key")).alias("stays")), "near")
    losers = stage(near.filter(~F.col("stays")).select(F.col("key").alias("l_key")), "losers")
    wide = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), key.alias("key"))
    out = wide.join(losers, wide["key"] == losers["l_key"], "left_anti")
    repeated = stage(near.filter("stays").groupBy(F.col("key").alias("r_key")).agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select("r_key"), "repeated-rows")
    if not repeated.isEmpty():
        again = wide.join(repeated, wide["key"] == repeated["r_key"], "left_semi").dropDuplicates(["key"])
        out = out.join(repeated, out["key"] == repeated["r_key"], "left_anti").unionByName(again)
    return out.select("row.*")
