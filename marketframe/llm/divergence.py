"""Source divergence audit by single-pass in-memory indexing.

How far the word use of each source of a language is from that of every other source, and
which words make a source stand out from its language. Probabilities are integers (parts of
``SCALE``, one count added to every term), and every sum is exact.

1. Block postings: one pass over the documents counts, per (lang, source), occurrences and
   documents of each term in memory. When the block holds ``BLOCK`` postings it is spilled as
   a run sorted by (lang, term, source) and the memory is given back.
2. Runs are dealt to hash shards of (lang, term) and heap-merged there: the shuffle's
   external sorter merges the sorted pieces, the task then adds up equal neighbours in one stream.
   A shard has all of a term, so the merge also decides whether the language keeps it.
3. Group totals give each group's probability of a term with and without occurrences.
4. Pair corrections: the divergence of sources a and b is a sum over all kept terms. Its
   part for terms that neither uses is a product; terms of one source only need the
   other's single zero probability, so they come from a histogram of the source's
   probabilities; terms of both are streamed shard by shard, and every pair met in a term
   adds to a running sum per pair. Nothing is made per term and pair outside a task.

Scale: what is shuffled is one row per posting of a run (terms are counted before they move, so a
frequent term has a row per run, not per occurrence), then one per kept posting. Tasks hold a
block, an Arrow batch and the sums of at most ``PAIRS`` pairs, which are passed on when more
come up. A source with a third of all documents has no task of its own. The table of groups and their
totals is joined by Spark, which broadcasts it when it is small; its result has a row for every pair of
sources of a language, so it is at most about the square root of the result.

Defined results: null texts, languages and sources count as the empty string; a group without
terms still gets its pairs, and value 0 where its language keeps no term; equal values are
ranked by the item's UTF-8 bytes; repeated documents count as often as they occur; an empty table
gives no rows; whole texts of any length are read; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
#: Postings of a block, of one spilled run at most (besides those of its last document).
BLOCK = 1 << 19
#: Pairs of sources whose sums a task holds, and pair terms computed at once.
PAIRS = 1 << 20
#: Bytes of a text that are split at once.
PIECE = 1 << 22

#: A term in the bytes of an ASCII-lower-cased text: letters and whatever is not ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")

_RUN = "lang string, term binary, source string, n long, docs long"
_MERGED = "lang string, term binary, source string, n long, total long, head int"
_JOINT = "lang string, a string, b string, both long, a_only long, b_only long, terms long"


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces that end between terms."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _run(block: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """The postings of a block, sorted by (lang, term, source)."""
    cols: list[list] = [[], [], [], [], []]
    for (lang, source), (n, docs) in block.items():
        terms = list(n)
        cols[0].append(pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(terms), np.int32)), [lang]).cast(pa.string()))
        cols[1].append(pa.array(terms, pa.binary()))
        cols[2].append(pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(terms), np.int32)), [source]).cast(pa.string()))
        cols[3].append(pa.array(np.fromiter(n.values(), np.int64, len(terms))))
        cols[4].append(pa.array(np.fromiter(map(docs.__getitem__, terms), np.int64, len(terms))))
    if cols[0]:
        t = pa.table([pa.chunked_array(c) for c in cols], names=["lang", "term", "source", "n", "docs"])
        yield from t.sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).to_batches(1 << 16)


def _postings(most: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents (lang, source, text) to sorted runs of about ``most`` postings."""
        block: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                n, docs = block.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for piece in _pieces(text.lower()):
                    terms = _TERM.findall(piece)
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(n) - before
                if held >= most:
                    yield from _run(block)
                    block, held = {}, 0
        yield from _run(block)
    return index


def _starts(*columns: pa.Array) -> np.ndarray:
    """True at rows that differ from the row before in one of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        if len(c) > 1:
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return new


def _whole_terms(batches: Iterator[pa.RecordBatch], fold) -> Iterator[pa.RecordBatch]:
    """Sorted batches, cut between terms; ``fold`` shrinks the rows of the term held back."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not len(batch):
            continue
        at = int(np.flatnonzero(_starts(batch.column(0), batch.column(1)))[-1])
        if at:
            yield batch.slice(0, at)
        rest = fold(batch.slice(at))
    if rest is not None and len(rest):
        yield rest


def _added(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Equal neighbours (lang, term, source) of a sorted batch added up."""
    at = np.flatnonzero(_starts(batch.column(0), batch.column(1), batch.column(2)))
    if not len(at) or len(at) == len(batch):
        return batch
    sums = [pa.array(np.add.reduceat(batch.column(i).to_numpy(), at)) for i in (3, 4)]
    return pa.record_batch([batch.column(i).take(pa.array(at)) for i in range(3)] + sums, schema=batch.schema)


def _merge(min_docs: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted runs of a shard to the frequencies of the terms that their language keeps."""
        for batch in _whole_terms(batches, _added):
            t = _added(batch)
            at = np.flatnonzero(_starts(t.column(0), t.column(1)))
            size = np.diff(np.append(at, len(t)))
            n, docs = (np.add.reduceat(t.column(i).to_numpy(), at) for i in (3, 4))
            head = np.zeros(len(t), np.int32)
            head[at] = 1
            out = pa.record_batch([*[t.column(i) for i in range(4)], pa.array(np.repeat(n, size)), pa.array(head)],
                                  names=["lang", "term", "source", "n", "total", "head"])
            yield out.filter(pa.array(np.repeat(docs >= min_docs, size)))
    return merge


def frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                min_docs: int = MIN_DOCS, block: int = BLOCK) -> DataFrame:
    """(lang, term, source, n, total, head): occurrences of every kept term in a group and in its
    language; ``head`` is 1 on one row of each term. Terms are the UTF-8 bytes."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    runs = rows.mapInArrow(_postings(block), _RUN)
    return runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source").mapInArrow(_merge(min_docs), _MERGED)


def _prob(n: Column, group: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (group + kept)), exact: in 64 bits where they hold it."""
    exact = _div((n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), (group + kept).cast("decimal(38,0)"))
    short = _div((n + 1) * F.lit(SCALE).cast("bigint"), group + kept)
    return F.lit(1).cast("bigint") + F.when(n < 9_000_000_000, short).otherwise(exact)


def _div(a: Column, b: Column) -> Column:
    """Integral division as a column (both sides are not negative)."""
    return F.call_function("div", a, b)


def _gap(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _exact_sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(38,0)"))


def groups(docs: DataFrame, freq: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, size, lang_size, kept, zero): occurrences of kept terms in every occurring group
    and its language, kept terms of the language, and the probability of a term without occurrence."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    every = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    own = freq.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("head").alias("heads"))
    zero = F.lit(0).cast("bigint")
    t = every.join(own, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("size", zero).alias("size"), F.coalesce("heads", zero).alias("heads"))
    whole = t.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.sum("heads").alias("kept"))
    t = t.join(whole, "lang")
    return t.select("lang", "source", "size", "lang_size", "kept",
                    F.when(F.col("kept") > 0, _prob(zero, F.col("size"), F.col("kept"))).alias("zero"))


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings (lang, term, source, p, zero), whole terms in order, to sums over the terms that two
    sources have in common: of the gap of their probabilities, and with one's zero in its place."""
    sums: dict[tuple[str, str, str], list[int]] = {}

    def out() -> pa.RecordBatch:
        rows = [(*k, *v) for k, v in sums.items()]
        kinds = [pa.string()] * 3 + [pa.int64()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                               names=["lang", "a", "b", "both", "a_only", "b_only", "terms"])

    gap = lambda x, y: (x - y) ** 2 // y
    for batch in _whole_terms(batches, lambda b: b):
        at = np.flatnonzero(_starts(batch.column(0), batch.column(1)))
        size = np.diff(np.append(at, len(batch)))
        first, mates = np.repeat(at, size), np.repeat(size, size)
        lang, source = batch.column(0).dictionary_encode(), batch.column(2).dictionary_encode()
        names = source.dictionary.to_pylist()
        langs = lang.dictionary.to_pylist()
        code = lang.indices.to_numpy().astype(np.int64) * len(names) + source.indices.to_numpy()
        p, z = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        done, work = 0, np.cumsum(mates)
        while done < len(batch):  # rows whose pairs fit the bound, one row at least
            base = work[done - 1] if done else 0
            end = max(done + 1, int(np.searchsorted(work, base + PAIRS, "right")))
            rows = np.arange(done, end)
            left = np.repeat(rows, mates[rows])
            right = np.arange(len(left)) - np.repeat(work[rows] - mates[rows] - base, mates[rows]) + first[left]
            ok = left != right
            left, right = left[ok], right[ok]
            key, where = np.unique(code[left] * (len(names) * len(langs)) + code[right], return_inverse=True)
            part = np.zeros((4, len(key)), np.int64)
            for k, v in enumerate((gap(p[left], p[right]), gap(p[left], z[right]), gap(z[left], p[right]), 1)):
                np.add.at(part[k], where, v)
            for i, (x, y) in enumerate(zip(*np.divmod(key, len(names) * len(langs)))):
                pair = sums.setdefault((langs[x // len(names)], names[x % len(names)], names[y % len(names)]), [0, 0, 0, 0])
                for k in range(4):
                    pair[k] += int(part[k, i])
            # a sum over terms stays below (2 * SCALE + 2 * kept terms) ** 2, within 64 bits
            if len(sums) >= PAIRS:
                yield out()
                sums.clear()
            done = end
    if sums:
        yield out()


def pair_values(freq: DataFrame, grouped: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence of every source from every other of its language."""
    g = grouped.filter(F.col("kept") > 0)
    post = freq.join(g, ["lang", "source"]).select(
        "lang", "term", "source", _prob(F.col("n"), F.col("size"), F.col("kept")).alias("p"), "zero")
    joint = (post.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_joint, _JOINT)
                 .groupBy("lang", "a", "b").agg(*[_exact_sum(F.col(c)).alias(c) for c in ("both", "a_only", "b_only", "terms")]))
    # terms of one source against each zero probability of its language
    zeros = g.select("lang", F.col("zero").alias("z")).distinct()
    hist = post.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    p, z, m = F.col("p"), F.col("z"), F.col("m").cast("decimal(18,0)")
    one = hist.join(zeros, "lang").groupBy("lang", "source", "z").agg(
        F.sum(m * _gap(p, z).cast("decimal(19,0)")).alias("out"), F.sum(m * _gap(z, p).cast("decimal(19,0)")).alias("back"),
        F.sum(m).alias("own"))
    one = stage(one, "divergence-single")
    side = lambda s: grouped.select("lang", F.col("source").alias(s), F.col("zero").alias(f"z_{s}"),
                                    *([F.col("kept")] if s == "a" else []))
    pairs = side("a").join(side("b"), "lang").filter(F.col("a") != F.col("b"))
    uses = lambda s, c: one.select("lang", F.col("source").alias(s), F.col("z").alias(f"z_{'b' if s == 'a' else 'a'}"),
                                   F.col(c).alias(f"{s}_sum"), F.col("own").alias(f"{s}_own"))
    t = (pairs.join(uses("a", "out"), ["lang", "a", "z_b"], "left").join(uses("b", "back"), ["lang", "b", "z_a"], "left")
              .join(joint, ["lang", "a", "b"], "left"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)"))
    none = _gap(F.col("z_a"), F.col("z_b")).cast("decimal(19,0)")
    neither = (F.col("kept").cast("decimal(18,0)") - n("a_own") - n("b_own") + n("terms")).cast("decimal(18,0)")
    value = neither * none + n("a_sum") - n("a_only") + n("b_sum") - n("b_only") + n("both")
    return t.select("lang", F.col("a").alias("source"), F.col("b").alias("item"),
                    F.when(F.col("kept") > 0, value).otherwise(F.lit(0)).cast("bigint").alias("value"))


def term_values(freq: DataFrame, grouped: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a source uses more than its language does."""
    t = freq.join(grouped, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _prob(F.col("n"), F.col("size"), F.col("kept")).alias("p"),
        _prob(F.col("total"), F.col("lang_size"), F.col("kept")).alias("q"))
    return t.filter(F.col("p") > F.col("q")).select("lang", "source", "item", _gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): per group every other source of its language
    (``pair``) and its ``top`` most divergent terms (``term``), from the largest value on."""
    freq = stage(frequencies(docs, text_col, lang_col, source_col, min_docs, block), "divergence-freq")
    grouped = stage(groups(docs, freq, lang_col, source_col), "divergence-groups")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pair_values(freq, grouped).withColumn("rank", rank)
    terms = term_values(freq, grouped).withColumn("rank", rank).filter(F.col("rank") <= top)
    part = lambda t, name: t.select("lang", "source", F.lit(name).alias("part"), F.col("item").cast("string").alias("item"),
                                    "value", F.col("rank").cast("int").alias("rank"))
    return part(pairs, "pair").unionByName(part(terms, "term"))
