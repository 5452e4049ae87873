"""Token-id files with Elias-Fano document boundaries.

A shard file holds, little-endian:

    magic "TOKEF001", then as unsigned 64-bit: id width in bytes (2 or 4),
    documents, tokens, and for each of two Elias-Fano sequences (boundaries, doc
    ids) the number of low bits and of high-part bytes; the first doc id as
    signed 64-bit; the number of leading documents without an id
    concatenated ids of all documents
    Elias-Fano boundaries: start of each document and the end of the last
    Elias-Fano doc ids, relative to the first one

Elias-Fano keeps ``l`` low bits of each value packed and the rest as ones in a
bit array, at position ``high + index``: about ``2 + log2(range / n)`` bits a
document instead of 64. ``select`` finds the i-th one through a directory of the
32-bit positions of every ``STEP``-th one, made on load; a run of values is
selected at once from the bytes between two entries.

Texts are encoded in the scan's stage and only their ids, in 16 or 32 bits, are shuffled: bounds of
(id, text hash) that share the bytes out evenly are taken from a sample (of ``SAMPLE`` keys at most,
as Spark's range partitioner does, whose own sampling would encode everything twice), each
row is sent to the partition of its key, about ``TASK_BYTES`` a task, and sorted there; rows that are alike
may lie on both sides of a bound. A writing task loads no
tokenizer; it writes one shard per ``SHARD_TOKENS`` under a name that no other attempt
uses, and Spark's commit of the manifest decides which attempt's files count. Readers
take the manifest's files only, and files of lost attempts are removed once it stands.
A document's global start is its start in the shard plus the tokens of earlier
shards, which is a prefix sum over the manifest (one row per shard).

Defined results: a null text is a document with just the end id; null ids come
first; documents with the same id keep the order of their texts' hash and rows
that are alike are all written; very long texts are encoded whole, in a batch of their
own; an empty table gives no files and no rows; other columns are ignored, whatever
their names. Ids must be integers.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packers, shared_folder, stage
from .tokens import END_ID, default_tokenizer, encoder, release, text_batches

MAGIC = b"TOKEF001"
HEAD = struct.Struct("<8s7QqQ")
SHARD_TOKENS = 4_000_000
TASK_BYTES = 32 << 20
SAMPLE = 1_000_000
STEP = 256
#: Documents read at once.
READ = 4096


def _bits(raw: bytes | np.ndarray, first: int, last: int) -> np.ndarray:
    """The bits of bytes ``first`` to ``last``, lowest first."""
    return np.unpackbits(np.frombuffer(raw, np.uint8)[first:last], bitorder="little") if len(raw) else np.zeros(0, np.uint8)


class EliasFano:
    """A non-decreasing sequence of integers from 0, of fewer than 2**31 high bits."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.directory = np.zeros(-(-n // STEP), np.uint32)  # where every STEP-th one stands
        seen = 0
        for at in range(0, len(high), 1 << 16):
            ones = np.flatnonzero(_bits(high, at, at + (1 << 16)))
            mine = ones[-seen % STEP::STEP]
            first = -(-seen // STEP)
            self.directory[first:first + len(mine)] = mine + 8 * at
            seen += len(ones)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"")
        low_bits = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1, np.uint8)
        bits[at] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes())

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        a, b = first * self.low_bits, last * self.low_bits
        raw = np.unpackbits(np.frombuffer(self.low, np.uint8)[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (raw.reshape(-1, self.low_bits) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, first: int, last: int | None = None) -> np.ndarray:
        """Values ``first`` to ``last`` (one value by default), from the bytes between the
        directory's entries around them."""
        last = first + 1 if last is None else last
        if not 0 <= first < last <= self.n:
            raise IndexError((first, last))
        a = int(self.directory[first // STEP]) // 8
        j = -(-last // STEP)
        b = int(self.directory[j]) // 8 + 1 if j < len(self.directory) else len(self.high)
        skip = first % STEP + int(_bits(self.high, a, a + 1)[:int(self.directory[first // STEP]) % 8].sum())
        ones = np.flatnonzero(_bits(self.high, a, b))[skip:skip + last - first] + 8 * a
        high = (ones - np.arange(first, last)).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | self._low(first, last)).astype(np.int64)

    @property
    def low_bytes(self) -> int:
        return -(-self.n * self.low_bits // 8)


def shard_bytes(doc_ids: list[int | None], sizes: np.ndarray, tokens: np.ndarray) -> bytes:
    """The file of documents in order: their ids, numbers of tokens, and all tokens."""
    width = 2 if not len(tokens) or int(tokens.max()) < 1 << 16 else 4
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    ends = EliasFano.encode(np.r_[0, np.cumsum(sizes)])
    names = EliasFano.encode(known.view(np.uint64) - np.uint64(first % (1 << 64)))
    head = HEAD.pack(MAGIC, width, len(sizes), len(tokens), ends.low_bits, len(ends.high), names.low_bits, len(names.high),
                     first, nulls)
    return b"".join([head, tokens.astype(f"<u{width}").tobytes(), ends.low, ends.high, names.low, names.high])


class Shard:
    """A shard file's content: ``ids(i)`` and ``doc_ids`` of its documents."""

    def __init__(self, content: bytes):
        magic, width, self.docs, self.tokens, el, eh, nl, nh, first, nulls = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.all = np.frombuffer(content, f"<u{width}", self.tokens, HEAD.size)
        at = HEAD.size + width * self.tokens

        def part(n: int, low_bits: int, high: int) -> EliasFano:
            nonlocal at
            low = -(-n * low_bits // 8)
            out = EliasFano(n, low_bits, content[at:at + low], content[at + low:at + low + high])
            at += low + high
            return out

        self.bounds = part(self.docs + 1, el, eh)
        self.names, self.nulls, self.first = part(self.docs - nulls, nl, nh), nulls, first

    def ids(self, i: int) -> np.ndarray:
        """Token ids of the i-th document."""
        a, b = self.bounds.select(i, i + 2)
        return self.all[a:b]

    def doc_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        """Ids of documents ``first`` to ``last``, null ids leading."""
        last = self.docs if last is None else last
        none = max(0, min(last, self.nulls) - first)
        if first + none >= last:
            return [None] * none
        known = self.names.select(first + none - self.nulls, last - self.nulls)
        return [None] * none + (known + self.first).tolist()


def _store(folder: str):
    """File system and path of a folder; Hadoop's names of a scheme are taken too."""
    from pyarrow import fs
    scheme, _, rest = folder.partition(":")
    folder = f"s3:{rest}" if scheme in ("s3a", "s3n") else folder
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


NO_ID = -(1 << 63)


class Bounds:
    """Upper bounds of partitions in the order of (id, text hash), null ids first."""

    def __init__(self, keys: list[tuple[int, int]]):
        self.ids = np.array([k[0] for k in keys], np.int64)
        self.hashes = [k[1] for k in keys]

    def parts(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The partition of each row; rows alike to several bounds are dealt to all between them."""
        low, high = (np.searchsorted(self.ids, ids, side) for side in ("left", "right"))
        out = low.astype(np.int32)
        for i in np.flatnonzero(low != high).tolist():  # ids that are a bound themselves
            h, a, b = int(hashes[i]), int(low[i]), int(high[i])
            first, last = bisect.bisect_left(self.hashes, h, a, b), bisect.bisect_right(self.hashes, h, a, b)
            out[i] = first + i % (last - first + 1)
        return out


def bounds(keys: DataFrame, task_bytes: int) -> tuple[Bounds, int]:
    """(bounds, partitions) for ``keys`` (doc_id, text_hash, size) of about ``task_bytes`` each."""
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = packers(int(total), task_bytes)
    if n == 1:
        return Bounds([]), 1
    part = min(1.0, min(100 * n, SAMPLE) / rows)
    seen = sorted((NO_ID if r["doc_id"] is None else r["doc_id"], r["text_hash"], r["size"])
                  for r in (keys if part == 1.0 else keys.sample(part, 7)).collect())
    at = np.cumsum([s for _, _, s in seen])
    cuts = np.searchsorted(at, at[-1] / n * np.arange(1, n)) if len(at) else []
    return Bounds([seen[i][:2] for i in cuts]), n


def encoded(docs: DataFrame, tokenizer: str | None = None, shares: Bounds | None = None) -> DataFrame:
    """(doc_id, text_hash, width, ids, part) of every document of (doc_id, text_hash, text): token ids and the end
    id, in ``width`` (2 or 4) bytes each, and the partition. One pass over the scan, without a shuffle."""
    path, shares = tokenizer or default_tokenizer(), shares or Bounds([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in text_batches({"text": texts}, "text", 2_000_000):
                ids, sizes = enc.columns(texts[a:b])
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, END_ID)
                width = 2 if int(ids.max()) < 1 << 16 else 4
                raw, at = ids.astype(f"<u{width}").tobytes(), (width * (ends + np.arange(1, len(ends) + 1))).tolist()
                cut = pa.array([raw[x:y] for x, y in zip([0, *at], at)], pa.binary())
                doc, hashes = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                part = shares.parts(doc.fill_null(NO_ID).to_numpy(), hashes.to_numpy())
                yield pa.record_batch([doc, hashes, pa.array([width] * (b - a), pa.int32()), cut, pa.array(part)],
                                      names=["doc_id", "text_hash", "width", "ids", "part"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, "doc_id long, text_hash long, width int, ids binary, part int")


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
          shard_tokens: int = SHARD_TOKENS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Writes the shards of all documents below ``folder`` (a path or URI that every
    executor reaches) and returns the manifest (shard, part, seq, docs,
    tokens, base): ``base`` is the number of tokens in earlier shards."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("text_hash", F.xxhash64("text"))
    shares, n = bounds(src.select("doc_id", "text_hash", (F.octet_length("text") + 16).alias("size")), task_bytes)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash").asc()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # this worker may have encoded before
        part, (fs, root) = TaskContext.get().partitionId(), _store(folder)
        fs.create_dir(root)
        seq, names, sizes, held, size = 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, names, sizes, held, size
            name = f"shard-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.bin"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(shard_bytes(names, np.array(sizes, np.int64), np.concatenate(held)))
            row = pa.record_batch([pa.array([x]) for x in (name, part, seq, len(names), size)],
                                  names=["shard", "part", "seq", "docs", "tokens"])
            seq, names, sizes, held, size = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for doc, width, raw in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                names.append(doc)
                held.append(np.frombuffer(raw, f"<u{width}"))
                sizes.append(len(held[-1]))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    done = stage(encoded(src, tokenizer, shares).repartitionById(n, "part").sortWithinPartitions(*order)
                 .select("doc_id", "width", "ids").mapInArrow(run, "shard string, part long, seq long, docs long, tokens long"),
                 "token-shards")
    _remove_others(docs.sparkSession, folder, done)
    # prefix sum in two levels: shards of a part, then parts
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = done.groupBy(F.col("part").alias("p")).agg(F.sum("tokens").alias("n"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("p", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("parts_before"))
    j = done.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return j.join(parts, j["part"] == parts["p"]).select(
        "shard", "part", "seq", "docs", "tokens", (F.col("parts_before") + F.col("before")).alias("base"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, content) of the shard files in ``folder``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder)
                 .select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "content"))


def _remove_others(spark: SparkSession, folder: str, manifest: DataFrame) -> None:
    """Deletes the shard files that no manifest row names: those of attempts that did not count."""
    if manifest.isEmpty():
        return
    left = _files(spark, folder).select("name", "path").join(manifest, F.col("name") == F.col("shard"), "left_anti")
    for row in left.select("path").toLocalIterator():  # as many as tasks died in the middle of a write
        where = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, False)


def read(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False,
         task_bytes: int = TASK_BYTES) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the shards
    that the manifest names; ``ids`` are unsigned 32-bit integers. A task opens its shards itself,
    one at a time."""
    if manifest.isEmpty():  # no documents, so no files
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long"
                                     + ", ids binary" * with_ids)
    total = manifest.agg(F.sum("tokens")).first()[0]
    shards = manifest.select("shard", "base").repartition(packers(2 * total, task_bytes), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        fs, root = _store(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    shard = Shard(f.read_buffer())
                for a in range(0, shard.docs, READ):
                    b = min(a + READ, shard.docs)
                    at = shard.bounds.select(a, b + 1)
                    ids = [shard.all[x:y].astype("<u4").tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                    cols = [pa.array(shard.doc_ids(a, b), pa.int64()), pa.array(at[:-1] + base), pa.array(np.diff(at)),
                            pa.array([zlib.crc32(x) for x in ids], pa.int64())] + [pa.array(ids, pa.binary())] * with_ids
                    yield pa.record_batch(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def write_and_read(docs: DataFrame, **kw) -> DataFrame:
    """Writes the shards to a fresh shared folder and reads every document back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    return read(spark, folder, stage(write(docs, folder, **kw), "token-manifest"))
