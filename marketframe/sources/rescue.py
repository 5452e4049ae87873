"""Rescued fields: what a payload holds beyond the columns of its feed.

The normalizers read the keys they know; the vendor may send more, and new ones without
notice. ``rescued`` keeps every unread key of a payload, and of each item of its lists, as one VARIANT
object beside its origin (feed, symbol, batch, path, position), whatever its type; ``rescued_fields`` has a
row per key. ``schema_drift`` merges the types of a batch's unread keys (``schema_of_variant_agg``), so
a new key, or one whose type changed from one batch to the next, is a row of a report.

One JSON parse a payload, into maps of VARIANT values; row-local, and the report is a grouped aggregate
with map-side merging. Payloads that are not of the feed's shape have no keys here (``feeds.quarantine``
reports them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import feeds as FD

_MAP = "map<string,variant>"


def _keys(schema: T.StructType) -> list[str]:
    return schema.fieldNames()


def _in(kind: T.DataType) -> T.StructType:
    return kind.elementType


#: Keys that the normalizers read: of the body (None: the body is a list), and of the items of each list in it.
READ: dict[str, tuple[list[str] | None, dict[str, list[str]]]] = {
    "quote": (_keys(FD.QUOTE), {}),
    "candle": (_keys(FD.CANDLE), {}),
    "profile": (_keys(FD.PROFILE), {}),
    "company_news": (None, {"": _keys(FD.NEWS_ITEM)}),
    "earnings": (None, {"": _keys(FD.EARNING)}),
    "financials": (_keys(FD.FINANCIALS), {"data": _keys(_in(FD.FINANCIALS["data"].dataType))}),
    "insider": (_keys(FD.INSIDER), {"data": _keys(_in(FD.INSIDER["data"].dataType))}),
    "recommendation": (None, {"": _keys(FD.RECOMMENDATION)}),
    "social": (_keys(FD.SOCIAL), {"reddit": _keys(FD.SOCIAL_ITEM), "twitter": _keys(FD.SOCIAL_ITEM)}),
    "dividend": (None, {"": _keys(FD.DIVIDEND)}),
    "market_news": (None, {"": _keys(FD.NEWS_ITEM)}),
    "ipo": (_keys(FD.IPO), {"ipoCalendar": _keys(_in(FD.IPO["ipoCalendar"].dataType))}),
}


def _objects(feed: str) -> Column:
    """Array of (path, pos, known, fields) of the objects in a feed's payload."""
    body_keys, lists = READ[feed]

    def entry(path: str, pos: Column, known: list[str], fields: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), pos.cast("int").alias("pos"),
                        F.array(*[F.lit(k) for k in known]).alias("known"), fields.alias("fields"))

    def items(path: str, known: list[str], arr: Column) -> Column:
        return F.coalesce(F.transform(arr, lambda x, i: entry(path, i, known, x)), F.array().cast(kind))

    kind = f"array<struct<path:string,pos:int,known:array<string>,fields:{_MAP}>>"
    if body_keys is None:
        return items("$[*]", lists[""], F.from_json("payload", f"array<{_MAP}>"))
    body = F.from_json("payload", _MAP)

    def parts(b: Column) -> Column:
        whole = F.array(entry("$", F.lit(None), body_keys, b))
        return F.concat(whole, *[items(f"$.{k}[*]", known, F.try_variant_get(b[k], "$", f"array<{_MAP}>"))
                                 for k, known in lists.items()])
    return F.transform(F.array(body), parts)[0]


def _rescued(landing: DataFrame, feed: str) -> DataFrame:
    t = landing.where(F.col("feed") == feed)
    t = t.select("feed", "symbol", "fetched_at", "batch_id", F.inline(_objects(feed)))
    extra = F.map_filter("fields", lambda k, v: ~F.array_contains("known", k))
    t = t.select("feed", "symbol", "fetched_at", "batch_id", "path", "pos", extra.alias("fields"))
    return t.where(F.size("fields") > 0)


def rescued_maps(landing: DataFrame, feeds: list[str] | None = None) -> DataFrame:
    """(feed, symbol, fetched_at, batch_id, path, pos, fields): the unread keys of every object."""
    out = None
    for feed in READ if feeds is None else feeds:
        t = _rescued(landing, feed)
        out = t if out is None else out.unionByName(t)
    return out


def rescued(landing: DataFrame, feeds: list[str] | None = None) -> DataFrame:
    """(feed, symbol, fetched_at, batch_id, path, pos, rescued): one VARIANT object of unread keys per object
    that has any. ``path`` is ``$`` for the body and ``$..[*]`` for the items of a list, numbered by ``pos``."""
    t = rescued_maps(landing, feeds)
    return t.withColumn("rescued", F.to_variant_object("fields")).drop("fields")


def rescued_fields(landing: DataFrame, feeds: list[str] | None = None) -> DataFrame:
    """(feed, symbol, fetched_at, batch_id, path, pos, key, value): a row per unread key."""
    t = rescued_maps(landing, feeds)
    return t.select("feed", "symbol", "fetched_at", "batch_id", "path", "pos", F.explode("fields").alias("key", "value"))


def schema_drift(fields: DataFrame) -> DataFrame:
    """(batch_id, feed, path, key, type, rows, before): every unread key of every batch with the merged type
    of its values, and its type in the newest earlier batch of the feed that had it (null: a new key)."""
    t = fields.groupBy("batch_id", "feed", "path", "key").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("rows"))
    from pyspark.sql import Window
    w = Window.partitionBy("feed", "path", "key").orderBy("batch_id")  # a row per batch
    return t.withColumn("before", F.lag("type").over(w))
