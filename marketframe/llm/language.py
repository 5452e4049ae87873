"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

A profile is a language's ``TOP`` most frequent letter n-grams (1 to 3 letters,
words padded by a blank) in order of frequency. A document's own ``TOP``
n-grams are ranked alike, and each language's distance is the sum over them of how
far out of place they are in its profile; an n-gram that it lacks costs
``TOP``. The smallest distance names the language.

An n-gram is one integer (three 21-bit code points), so counting a text is
sorting an array, with no Python work per n-gram. Training counts are
summed in each task, then by an aggregation over (language, n-gram); the best
``TOP`` of a language are taken in two levels, first within slices of its
n-grams. Profiles are broadcast in groups of ``GROUP`` languages, so that a broadcast
holds at most ``GROUP * TOP`` integers however many languages there are.

Defined results: a null text or one without a letter gives ``und`` and score 0;
so does every text where nothing was learned; ties between n-grams go to
the smaller code points, between languages to the smaller name; null languages are
not learned; repeated rows are predicted (and learned from) as often as they
occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .tokens import text_batches

TOP = 300
GROUP = 1024
SLICES = 64
UNKNOWN = "und"
_CHUNK = 1_000_000
_FLUSH = 1_000_000
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; built once a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(np.concatenate(codes), return_inverse=True)
    return u, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter n-grams of a whole text, read in pieces of
    bounded size. Letters are lower-cased; all other characters are blanks."""
    codes, counts, tail = [], [], np.array([32, 32], np.int64)
    for k in range(0, len(text), _CHUNK):
        part = text[k:k + _CHUNK].lower()
        raw = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        last = k + _CHUNK >= len(text)
        c = np.concatenate([tail, np.where(_letters()[raw], raw, 32)] + [np.array([32], np.int64)] * last)
        a, b, z = c[:-2], c[1:-1], c[2:]  # n-grams that end at z
        tail = c[-2:]
        letter = z != 32
        grams = np.concatenate([
            z[letter],  # one letter
            ((b << 21) | z)[(b != 32) | letter],  # two, either may be the blank before or after a word
            ((a << 42) | (b << 21) | z)[b != 32]])  # three around a letter
        u, n = np.unique(grams, return_counts=True)
        codes.append(u)
        counts.append(n)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (codes[0], counts[0]) if len(codes) == 1 else _merge(codes, counts)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent codes in order of rank; codes come sorted."""
    if len(codes) > top:  # all codes above the last count that can rank, then exact order
        cut = np.partition(counts, len(counts) - top)[len(counts) - top]
        near = counts >= cut
        codes, counts = codes[near], counts[near]
    return codes[np.argsort(-counts, kind="stable")][:top]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, code, rank): the profile of every language, ranks from 0."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for lang, (codes, counts) in held.items():
                u, n = _merge(codes, counts)
                yield pd.DataFrame({"lang": lang, "code": u, "n": n})

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                codes, counts = ngram_counts(text)
                mine = held.setdefault(lang, [[], []])
                mine[0].append(codes)
                mine[1].append(counts)
                size += len(codes)
                if size >= _FLUSH:
                    held = {k: [[x] for x in _merge(*v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size >= _FLUSH // 2:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    total = src.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = [F.col("n").desc(), F.col("code")]
    part = Window.partitionBy("lang", "slice").orderBy(*best)
    whole = Window.partitionBy("lang").orderBy(*best)
    few = (total.withColumn("slice", F.pmod(F.xxhash64("code"), F.lit(SLICES)))
                .withColumn("r", F.row_number().over(part)).filter(F.col("r") <= top))
    return (few.withColumn("rank", F.row_number().over(whole) - 1).filter(F.col("rank") < top)
               .select("lang", "code", "rank"))


class Profiles:
    """Ranks of a group of languages by n-gram code."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64))
        where = {x: i for i, x in enumerate(self.langs)}
        # one column of ranks per code, absent ones at -1
        self.rank = np.full((len(self.langs), len(self.codes)), -1, np.int16)
        self.rank[[where[r[0]] for r in rows], np.searchsorted(self.codes, [r[1] for r in rows])] = [r[2] for r in rows]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of each language from the codes ``own`` in order of rank."""
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        ranks = self.rank[:, at[known]].astype(np.int64)
        place = np.abs(ranks - np.flatnonzero(known))
        return np.where(ranks < 0, self.top, place).sum(axis=1) + self.top * int((~known).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 less the distance over the largest possible one."""
        own = ranked(*ngram_counts(text or ""), self.top)
        if not len(own):
            return UNKNOWN, 0.0
        d = self.distances(own)
        i = int(np.argmin(d))  # the first of equals
        return self.langs[i], 1.0 - float(d[i]) / (self.top * len(own))


def predict(docs: DataFrame, profiles: DataFrame, carry: dict[str, Column], text_col: str = "text",
            top: int = TOP, group: int = GROUP) -> DataFrame:
    """The ``carry`` columns, lang_pred and score for every row of ``docs``."""
    spark = docs.sparkSession
    langs = stage(profiles, "profiles")
    numbered = stage(langs.select("lang").distinct()
                     .withColumn("g", F.floor((F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("lang")) - 1)
                                              / F.lit(group))), "languages")
    groups = numbered.agg(F.max("g")).first()[0]
    src = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_col).cast("string").alias("llm_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema = f"{fields}, lang_pred string, score double"
    if groups is None:  # nothing learned
        return src.drop("llm_text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    def scored(frame: DataFrame, g: int) -> DataFrame:
        part = langs.join(numbered.filter(F.col("g") == g).select("lang"), "lang", "left_semi")
        known = spark.sparkContext.broadcast([tuple(r) for r in part.select("lang", "code", "rank").collect()])

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = Profiles(known.value, top)
            for part in frames:
                for a, b in text_batches(part, "llm_text"):
                    rows = part.iloc[a:b]
                    out = [model.predict(t) for t in rows["llm_text"]]
                    yield rows.drop(columns="llm_text").assign(
                        lang_pred=[x[0] for x in out], score=[x[1] for x in out])

        return frame.mapInPandas(run, schema)

    if groups == 0:
        return scored(src, 0)
    # more languages than one group: best of the groups, per row
    rows = stage(src.withColumn("llm_row", F.monotonically_increasing_id()), "language-rows")
    schema = f"{fields}, llm_row long, lang_pred string, score double"
    every = None
    for g in range(int(groups) + 1):
        one = scored(rows.select(*[c for c in rows.columns if c != "llm_text"], "llm_text"), g)
        every = one if every is None else every.unionByName(one)
    names = list(carry)
    best = every.groupBy("llm_row").agg(F.min(F.struct((-F.col("score")).alias("s"), "lang_pred", *names)).alias("b"))
    return best.select(*[F.col(f"b.{n}") for n in names], F.col("b.lang_pred").alias("lang_pred"),
                       (-F.col("b.s")).alias("score"))
