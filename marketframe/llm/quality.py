"""Quality rules with adaptive thresholds (built-in expressions only).

Each document gets word and line statistics. Per (language, source) the ratios
built from them go into a quantile sketch: logarithmic buckets of relative
width ``GAMMA`` with a count each, so two sketches merge by adding counts and
one aggregation with map-side partial sums builds all of them. Sketches of a
source with fewer than ``MIN_GROUP`` documents are merged into the sketch of
its language, and those of a small language into the sketch of the table.

A threshold is a fence around the median of the sketch: ``median + K * max(median -
q05, floor)`` and, for two-sided ratios, the same below with a floor of its own. The lower half gives the
spread, so up to half of a source may be junk; the floor keeps a uniform
source from rejecting small natural variation. The ratios: symbols a word, words equal to the one
before them, repeated lines, and word length (repeated windows are the base rule's). The thresholds are then joined
to the documents, which are filtered by them.

Sketches are deterministic: the same documents give the same thresholds
whatever the partitioning or retries.

Defined results: a null text has no words; null language or source values are
groups of their own (null-safe); an empty table gives no rows; ties in a
sketch share a bucket; repeated rows count as often as they occur; texts of any length
are whole (a row is one task's); other columns are kept and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import SPACE_CHARS, SPACE_CLASS, let, stage

GAMMA = 1.02
MIN_GROUP = 50
K = 4.0
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: ratio -> (numerator, denominator, spread floor above the median, and below it (None: no lower fence))
RATIOS: dict[str, tuple[str, str, float, float | None]] = {
    "symbol_ratio": ("n_symbols", "n_words", 0.05, None),
    "stutter_ratio": ("n_stutter", "n_words", 0.05, None),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.1, None),
    "word_length": ("word_chars", "n_words", 1.25, 0.75),
}


def _clean(text: Column) -> Column:
    """Text without white space."""
    return F.translate(text, SPACE_CHARS, "")


def _windows(h: Column) -> Column:
    """64-bit hashes of all runs of ``WINDOW`` words, from the words' hashes."""
    return F.when(F.size(h) >= WINDOW,
                  F.transform(F.sequence(F.lit(0), F.size(h) - F.lit(WINDOW)),
                              lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def _stutters(h: Column) -> Column:
    """Words equal to the word before them, from the words' hashes."""
    return F.size(F.filter(h, lambda x, i: (i > 0) & (F.get(h, i - 1) == x)))


def _covered(wins: Column) -> Column:
    """Words covered by a window that occurs twice or more."""
    def count(s):  # s: (hash, position) sorted
        twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                         | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        at = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b))

    pairs = F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0).cast("bigint")).otherwise(let(pairs, count))


def text_stats(text_col: str) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
    and n_stutter (all long) of the whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE_CLASS), "")
    lines = F.filter(F.split(text, "\n"), lambda s: _clean(s) != "")
    long = lambda c, n: c.cast("bigint").alias(n)

    def of(ws):
        return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: let(lines, lambda ls: F.struct(
            long(F.size(ws), "n_words"), long(F.length(_clean(text)), "word_chars"),
            long(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), "n_symbols"),
            long(F.size(ls), "n_lines"), long(F.size(ls) - F.size(F.array_distinct(ls)), "n_dup_lines"),
            long(let(_windows(h), _covered), "n_repeat_words"), long(_stutters(h), "n_stutter"))))

    return let(words, of)


def base_failed(stats: str = "stats") -> Column:
    n, rep = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 10) | (F.lit(100) * rep > F.lit(20) * n)


def _ratio(name: str, stats: str = "stats") -> Column:
    num, den, _, _ = RATIOS[name]
    return F.col(f"{stats}.{num}").cast("double") / F.greatest(F.col(f"{stats}.{den}"), F.lit(1)).cast("double")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): one sketch per language, source and
    ratio over rows that have ``lang``, ``source`` and ``stats``. The bucket of
    x > 0 is ceil(log_gamma x); zero has the bucket null."""
    long = rows.select("lang", "source", F.inline(F.array(
        *[F.struct(F.lit(r).alias("ratio"), _ratio(r).alias("x")) for r in RATIOS])))
    bucket = F.when(F.col("x") > 0, F.ceil(F.log(F.col("x")) / F.log(F.lit(GAMMA))).cast("int"))
    return long.groupBy("lang", "source", "ratio", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sk: DataFrame, *keys: str) -> DataFrame:
    return sk.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def _fences(sk: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, size, fences): low and high of each ratio, as a map."""
    by = [*keys, "ratio"]
    w = Window.partitionBy(*by)
    below = w.orderBy(F.col("bucket").asc_nulls_first())
    t = sk.withColumns({"cum": F.sum("n").over(below), "size": F.sum("n").over(w)})
    at = lambda p: F.min(F.when(F.col("cum") * 100 >= F.col("size") * p, F.struct(F.col("cum"), F.col("bucket"))))
    q = t.groupBy(*by).agg(F.max("size").alias("size"), at(50).alias("m"), at(5).alias("l"))
    value = lambda c: F.when(F.col(f"{c}.bucket").isNull(), F.lit(0.0)).otherwise(
        F.lit(2.0) * F.pow(F.lit(GAMMA), F.col(f"{c}.bucket").cast("double")) / F.lit(GAMMA + 1.0))
    floor = lambda side: F.element_at(F.create_map(*[
        x for r, v in RATIOS.items() for x in (F.lit(r), F.lit(v[side]).cast("double"))]), F.col("ratio"))
    spread = lambda side: F.lit(K) * F.greatest(value("m") - value("l"), floor(side))
    fence = F.struct((value("m") - spread(3)).alias("low"), (value("m") + spread(2)).alias("high"))
    return (q.select(*keys, "size", "ratio", fence.alias("fence"))
             .groupBy(*keys).agg(F.max("size").alias("size"),
                                 F.map_from_entries(F.collect_list(F.struct("ratio", "fence"))).alias("fences")))


def _table_fences(sk: DataFrame) -> Column:
    """Fences of the whole table as constants: one low and high per ratio."""
    row = _fences(merge_sketches(sk).withColumn("one", F.lit(1)), ["one"]).first()
    if row is None:
        return F.lit(None)
    return F.create_map(*[x for r, f in row["fences"].items() for x in (
        F.lit(r), F.struct(F.lit(f["low"]).alias("low"), F.lit(f["high"]).alias("high")))])


def thresholds(rows: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, fences) for every (lang, source) of ``rows``: from its own
    sketch, or that of its language or of the table where documents are few.
    One row per (lang, source), each with one fence per ratio."""
    sk = stage(sketches(rows), "sketches")
    own = _fences(sk, ["lang", "source"])
    lang = _fences(merge_sketches(sk, "lang"), ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("size").alias("l_size"), F.col("fences").alias("l_fences"))
    j = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    pick = (F.when(F.col("size") >= min_group, F.col("fences"))
             .when(F.col("l_size") >= min_group, F.col("l_fences")).otherwise(_table_fences(sk)))
    return stage(j.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), pick.alias("fences")),
                 "thresholds")


def _inside(fences: str = "fences") -> Column:
    ok = F.lit(True)
    for r, (_, _, _, low) in RATIOS.items():
        f = F.element_at(F.col(fences), r)
        ok = ok & (_ratio(r) <= f["high"])
        if low is not None:
            ok = ok & (_ratio(r) >= f["low"])
    return ok


def _judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` (lang, source, stats, base_failed, ..) with ``kept``. The thresholds have one
    small row per (language, source): Spark broadcasts them when their measured
    size allows it and otherwise shuffles, where skew-join splitting spreads a
    hot source."""
    j = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")),
                  "left")
    return j.withColumn("kept", ~F.col("base_failed") & F.coalesce(_inside(), F.lit(True)))


def _stats_rows(docs: DataFrame, carry: list[str], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    row = [F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []
    return docs.select(*row, F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       text_stats(text_col).alias("stats")).withColumn("base_failed", base_failed())


def quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            carry: list[str] | None = None, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of the ``carry`` columns, the id column
    ``doc_id`` by default), ``stats``, ``base_failed`` and ``kept``. Statistics are computed
    once and staged without texts; sketches (over rows that pass the base rule)
    and filter both read the staged rows."""
    carry = ["doc_id"] if carry is None else carry
    rows = stage(_stats_rows(docs, carry, text_col, lang_col, source_col), "quality")
    limits = thresholds(rows.filter(~F.col("base_failed")), min_group)
    return _judged(rows, limits).select("row", "stats", "base_failed", "kept")


def drop_low_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                     min_group: int = MIN_GROUP) -> DataFrame:
    """``docs`` without the rows that the rules reject; columns unchanged. A first pass
    stages the statistics without the rows and builds the thresholds; the filter pass
    computes the statistics again, which is cheaper than a second copy of all texts."""
    rows = stage(_stats_rows(docs, [], text_col, lang_col, source_col), "quality")
    limits = thresholds(rows.filter(~F.col("base_failed")), min_group)
    wide = _stats_rows(docs, docs.columns, text_col, lang_col, source_col)
    return _judged(wide, limits).filter("kept").select("row.*")
