"""Benchmark decontamination by winnowing (built-in expressions only).

Every run of ``gram`` consecutive words has a 64-bit hash, and of every ``window - gram
+ 1`` consecutive hashes the smallest is kept. Two texts that share ``window`` words in
a row share all hashes under that run, so they keep a common one: joining the kept
hashes of documents and benchmark items misses no shared window, while only about
2 / (window - gram + 2) of the hashes are looked at.

1. Items: their windows (an item of fewer than ``window`` words is one window of its own
   length) with the items that hold them, and the kept hashes. Both are staged.
2. Documents: one scan makes the kept hashes and joins them on the items'. Only hits go on,
   as (text digest, position); equal texts are one from here on.
3. A hit is extended: all windows that hold the hit's run are cut from the text of the
   documents with hits and compared word for word with the items' windows.
4. Per text: words covered by the confirmed windows, and items found; joined to all documents.

Scale: the kept hashes of the items are a staged table, so Spark knows their size when it
plans: under the broadcast threshold they are broadcast and documents are only scanned;
above it both sides are shuffled as (hash, 16-byte digest, position), about the size of
the text, and skew-join splitting spreads a passage that many documents share. No
pairs of documents and items are made before the hits are confirmed: an item's windows
are first grouped into classes with the same items, and a text holds each class once.

Defined results: a null or wordless text has no windows and no hits; null item ids count as
the empty string; repeated items (same id) count once, repeated documents each get their
row; an empty benchmark leaves every document clean, an empty table gives no rows; whole
texts of any length are used; other columns may have any name, those named in ``carry``
are returned in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stage

WINDOW = 10
GRAM = 5
#: ASCII characters that are no part of a word, in lower-cased text (fixed values).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Window lengths fit into the low bits of a packed (position, length).
_LENGTHS = 64


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, cut at ASCII characters other than letters and digits."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS), "")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text: the first half of its SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, 32))


def _first(name: str, xs: list[Column]) -> Column:
    return xs[0] if len(xs) == 1 else getattr(F, name)(*xs)


def _winnowed(hashes: Column, length: int, gram: int) -> Column:
    """Kept (hash, at) of a text's word hashes for windows of ``length`` words: a hash is kept
    if it is the smallest of one of the ``length - gram + 1`` hashes in a row that hold it;
    all of several equal ones are kept. ``at`` packs the position with ``length``."""
    k = min(gram, length)
    w = length - k + 1
    grams = F.transform(F.sequence(F.lit(0), F.size(hashes) - F.lit(k)),
                        lambda i: F.xxhash64(F.lit(length), *[F.get(hashes, i + j) for j in range(k)]))

    def kept(g: Column, low: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(g) - F.lit(1)),
                      lambda i: F.get(g, i) == _first("greatest", [F.get(low, i - j) for j in range(w)]))
        return F.transform(at, lambda i: F.struct(F.get(g, i).alias("hash"),
                                                  (i.cast("bigint") * _LENGTHS + length).alias("at")))

    def lows(g: Column) -> Column:
        if w == 1:
            return kept(g, g)
        low = F.transform(F.sequence(F.lit(0), F.size(g) - F.lit(w)),
                          lambda i: F.least(*[F.get(g, i + j) for j in range(w)]))
        return let(low, lambda m: kept(g, m))

    return F.when(F.size(hashes) >= length, let(grams, lows)).otherwise(
        F.array().cast("array<struct<hash:bigint,at:bigint>>"))


def fingerprints(ws: Column, lengths: list[int], gram: int = GRAM) -> Column:
    """Kept (hash, at) of a word array for windows of each of ``lengths`` words."""
    return let(F.transform(ws, lambda x: F.xxhash64(x)),
               lambda h: F.concat(*[_winnowed(h, n, gram) for n in lengths]))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(window, length, items, items_class): every distinct window text of the items, the
    sorted ids of the items that hold it and a digest of them."""
    t = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("ws"))
    t = t.filter(F.size("ws") > 0).withColumn("length", F.least(F.size("ws"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("length") + 1)).alias("i")
    w = t.select("item", "ws", "length", at).select(
        "item", "length", F.array_join(F.slice("ws", F.col("i"), F.col("length")), " ").alias("window")).distinct()
    w = w.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return w.withColumn("items_class", F.sha2(F.to_json("items"), 256))


def occurrences(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "item_id",
                item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(found, classes): where items' windows occur in documents' texts, as (key, start, length,
    items_class) with ``key`` = ``text_key``, and the (items_class, items) behind them."""
    if window >= _LENGTHS:
        raise ValueError(f"windows must be shorter than {_LENGTHS} words")
    wins = stage(item_windows(items, id_col, item_text_col, window), "leak-windows")
    lengths = sorted(r["length"] for r in wins.select("length").distinct().collect())  # ``window`` of them at most
    classes = wins.select("items_class", "items").dropDuplicates(["items_class"])
    text = F.col(text_col)
    if not lengths:
        none = docs.select(text_key(text).alias("key"), F.lit(0).cast("bigint").alias("start"), F.lit(0).alias("length"),
                           F.lit("").alias("items_class")).filter(F.lit(False))
        return none, classes
    # whole items keep the hashes: winnowing window by window would keep one for each window as well
    t = items.select(words(F.col(item_text_col)).alias("ws")).filter(F.size("ws") > 0)
    own = F.concat(*[F.when(F.least(F.size("ws"), F.lit(window)) == n, fingerprints(F.col("ws"), [n], gram))
                     .otherwise(F.array().cast("array<struct<hash:bigint,at:bigint>>")) for n in lengths])
    marks = stage(t.select(F.inline(own)).select("hash").distinct(), "leak-marks")
    kept = docs.select(text_key(text).alias("key"), F.inline(fingerprints(words(text), lengths, gram)))
    hits = kept.join(marks, "hash", "left_semi").groupBy("key").agg(F.collect_set("at").alias("hits"))
    hits = stage(hits, "leak-hits")
    return _extended(docs, hits, wins, text, gram), classes


def _extended(docs: DataFrame, hits: DataFrame, wins: DataFrame, text: Column, gram: int) -> DataFrame:
    """Windows of the texts with hits that hold a hit's run and equal an item's window."""
    t = docs.select(text_key(text).alias("key"), text.cast("string").alias("text")).join(hits, "key")

    def starts(ws: Column) -> Column:
        def around(x: Column) -> Column:
            n, at = x % _LENGTHS, F.floor(x / _LENGTHS)
            spare = n - F.least(n, F.lit(gram))
            return F.transform(F.sequence(F.greatest(at - spare, F.lit(0).cast("bigint")), F.least(at, F.size(ws) - n)),
                               lambda s: s * _LENGTHS + n)
        return F.array_distinct(F.flatten(F.transform("hits", around)))

    def cut(ws: Column) -> Column:
        return F.transform(starts(ws), lambda x: F.struct(
            F.floor(x / _LENGTHS).alias("start"),
            F.array_join(F.slice(ws, (F.floor(x / _LENGTHS) + 1).cast("int"), (x % _LENGTHS).cast("int")), " ").alias("window")))

    candidates = t.select("key", F.inline(let(words(F.col("text")), cut)))
    return candidates.distinct().join(wins.select("window", "length", "items_class"), "window").select(
        "key", "start", "length", "items_class")


def per_text(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, n_hit, items): words inside a window and sorted items, one row per text with hits."""
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    gain = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    covered = found.select("key", gain.alias("gain")).groupBy("key").agg(F.sum("gain").cast("bigint").alias("n_hit"))
    held = found.select("key", "items_class").distinct().join(classes, "items_class").groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return covered.join(held, "key")


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "item_id",
                  item_text_col: str = "text", carry: list[str] | None = None, window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of the ``carry`` columns, ``doc_id`` by default),
    n_words, n_hit, items (sorted ids of the items with a window in the text) and contaminated."""
    found, classes = occurrences(docs, items, text_col, id_col, item_text_col, window, gram)
    leaks = stage(per_text(stage(found, "leak-found"), classes), "leaks").withColumnRenamed("key", "leak_key")
    carry = ["doc_id"] if carry is None else carry
    text = F.col(text_col)
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), text_key(text).alias("key"),
                       F.size(words(text)).cast("bigint").alias("n_words"))
    j = rows.join(leaks, F.col("key") == F.col("leak_key"), "left")
    hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("bigint"))
    return j.select("row", "n_words", hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; columns unchanged."""
    return contamination(docs, items, carry=docs.columns, **options).filter(~F.col("contaminated")).select("row.*")
