"""Bindings of the provided test tables to the engine's input schemas.

These functions only shape rows of the given tables into the schemas the
jobs expect (bars, quotes, landing payloads, status log). They do none of
the jobs' work; every query runs the library's operators on their output.
Each binding has a twin SQL text in ``marketframe.plans.sqlparts`` so the
DuckDB oracle starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one provided table; TIMESTAMP_NTZ columns become TIMESTAMP (UTC)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*casts)


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: daily OHLCV bars per event type (5 symbols x 30 days)."""
    ev = read(spark, sf_dir, "events")
    tie = F.struct("ts", "event_id")
    return (ev.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
              .agg(F.min_by("value", tie).alias("open"), F.max("value").alias("high"),
                   F.min("value").alias("low"), F.max_by("value", tie).alias("close"),
                   F.count(F.lit(1)).cast("double").alias("volume")))


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: daily OHLCV bars per part brand from lineitem x part.

    Plain equi-join; Catalyst/AQE pick broadcast only when the runtime size of
    ``part`` is under the broadcast threshold, else a shuffle join.
    """
    li = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    tie = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return (j.groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"))
             .agg(F.min_by(price, tie).alias("open"), F.max(price).alias("high"),
                  F.min(price).alias("low"), F.max_by(price, tie).alias("close"),
                  F.sum("l_quantity").alias("volume")))


def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one tick of a single series ``ALL`` (a hot key
    holding all rows): close = unit price, ordered by ship date and the line
    identity (l_orderkey, l_linenumber, l_extendedprice, l_quantity)."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.lit("ALL").alias("symbol"), F.to_date("l_shipdate").alias("date"),
                     "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"))


def batch_id_of(date_col: Column) -> Column:
    return F.concat(F.date_format(date_col, "yyyyMMdd"), F.lit("_000000"))


def quotes_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per symbol and day from B1; the day is the batch."""
    b = bars_events(spark, sf_dir)
    prev = b.select("symbol", F.date_add("date", 1).alias("date"),
                    F.col("close").alias("previous_close"))
    q = b.join(prev, ["symbol", "date"], "left")
    return q.select(
        "symbol",
        F.col("close").alias("current_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("open").alias("open_price"),
        "previous_close",
        (F.col("close") - F.col("previous_close")).alias("change"),
        (F.try_divide(F.col("close") - F.col("previous_close"), F.col("previous_close")) * 100
         ).alias("change_percent"),
        F.col("date").cast("timestamp").alias("timestamp"),
        batch_id_of(F.col("date")).alias("batch_id"),
    )


def bars_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 with holes in close/volume and the rows of days 5 and 6 repeated."""
    b = bars_events(spark, sf_dir)
    hole = F.dayofmonth("date") % 7 == 3
    g = b.select("symbol", "date", "open", "high", "low",
                 F.when(~hole, F.col("close")).alias("close"),
                 F.when(~hole, F.col("volume")).alias("volume"))
    rep = g.where(F.dayofmonth("date").isin(5, 6))
    return g.unionByName(rep).withColumn("batch_id", F.lit("20240131_000000"))


def bars_brand_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 in yearly batches with holes in close and volume and repeated rows;
    grows with the line items."""
    b = bars_brand(spark, sf_dir)
    day = F.dayofmonth("date")
    g = b.select("symbol", "date", "open", "high", "low", F.when(day % 7 != 3, F.col("close")).alias("close"),
                 F.when(day % 5 != 2, F.col("volume")).alias("volume"),
                 F.concat(F.date_format("date", "yyyy"), F.lit("1231_000000")).alias("batch_id"))
    return g.unionByName(g.where(F.dayofmonth("date").isin(5, 6)))


def quotes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quote per line item, monthly batches, symbol = supplier modulo 50 with a
    third of all rows on symbol ``HOT``; missing prices and other cells, repeated rows."""
    li = read(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    q = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("S"), (F.col("l_suppkey") % 50).cast("string"))).alias("symbol"),
        F.when(F.col("l_linenumber") % 3 != 2, price).alias("current_price"),
        F.when(F.col("l_linenumber") % 4 != 1, F.col("l_extendedprice") / 30).alias("previous_close"),
        F.when(F.col("l_orderkey") % 5 != 1, F.col("l_tax")).alias("change"),
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("01_000000")).alias("batch_id"), "l_orderkey")
    return q.unionByName(q.where(F.col("l_orderkey") % 10 == 0)).drop("l_orderkey")


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status updates (service, field, value, ts, seq) from events."""
    ev = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    fields = F.element_at(F.array(*[F.lit(x) for x in ("status", "message", "timestamp", "files")]),
                          (k % 4 + 1).cast("int"))
    return ev.select(F.col("event_type").alias("service"), fields.alias("field"),
                     F.format_string("%.2f", "value").alias("value"),
                     F.col("ts"), F.col("event_id").alias("seq"))


# ---------------------------------------------------------------- B5: landing payloads
#
# Each builder serializes rows of the provided tables into the vendor's JSON
# shape, one landing row per response. Groups are bounded (a calendar span,
# a doc-id range of 16/32, one supplier-month), never a whole table.

FETCH_BATCH = "20240131_000000"


def _landing(df: DataFrame, feed: str, symbol, payload, batch=None, fetched=None) -> DataFrame:
    return df.select(F.lit(feed).alias("feed"),
                     (symbol if isinstance(symbol, Column) else F.lit(symbol)).cast("string").alias("symbol"),
                     (fetched if fetched is not None else F.lit("2024-01-31 00:00:00")).cast("timestamp")
                     .alias("fetched_at"),
                     (batch if batch is not None else F.lit(FETCH_BATCH)).alias("batch_id"),
                     payload.alias("payload"))


def landing_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote responses from B3, plus responses without ``c`` (events props)."""
    q = quotes_events(spark, sf_dir)
    body = F.to_json(F.struct(F.col("current_price").alias("c"), F.col("high_price").alias("h"),
                              F.col("low_price").alias("l"), F.col("open_price").alias("o"),
                              F.col("previous_close").alias("pc"), F.col("change").alias("d"),
                              F.col("change_percent").alias("dp")))
    good = _landing(q, "quote", F.col("symbol"), body, F.col("batch_id"), F.col("timestamp"))
    ev = read(spark, sf_dir, "events")
    other = _landing(ev, "quote", F.col("event_type"), F.col("props"),
                     batch_id_of(F.to_date("ts")), F.col("ts"))
    return good.unionByName(other)


def _field(name: str):
    return lambda x: x[name]


def landing_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle responses: B1 arrays per symbol over its 30-day span (sorted by
    date), plus a ``no_data`` response per symbol."""
    b = bars_events(spark, sf_dir)
    g = b.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(
        "date", "open", "high", "low", "close", "volume"))).alias("a"))
    body = F.to_json(F.struct(
        F.lit("ok").alias("s"),
        F.transform("a", lambda x: F.unix_timestamp(x["date"].cast("timestamp"))).alias("t"),
        *[F.transform("a", _field(k)).alias(s) for k, s in
          (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"), ("volume", "v"))]))
    ok = _landing(g, "candle", F.col("symbol"), body)
    nodata = _landing(g, "candle", F.col("symbol"), F.to_json(F.struct(F.lit("no_data").alias("s"))))
    return ok.unionByName(nodata)


def landing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile responses from supplier x nation."""
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"),
                                             F.col("s_nationkey") == F.col("n_nationkey"))
    body = F.to_json(F.struct(F.col("s_name").alias("name"), F.col("n_name").alias("country"),
                              F.col("s_acctbal").alias("marketCapitalization")))
    return _landing(s, "profile", F.col("s_name"), body)


def _doc_news(spark, sf_dir, feed, group, symbol, with_related):
    d = read(spark, sf_dir, "documents")
    item = F.struct(F.col("doc_id").alias("datetime"), F.col("text").alias("headline"),
                    F.col("source").alias("source"), F.col("lang").alias("category"),
                    *([F.col("lang").alias("related")] if with_related else []))
    keys = [F.floor(F.col("doc_id") / group).alias("g")] + ([F.col("lang").alias("sym")] if symbol else [])
    g = d.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return _landing(g, feed, F.col("sym") if symbol else F.lit(None), F.to_json("items"))


def landing_company_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company news responses: documents of one language in doc-id ranges of 16."""
    return _doc_news(spark, sf_dir, "company_news", 16, True, False)


def landing_market_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market news responses: documents in doc-id ranges of 32."""
    return _doc_news(spark, sf_dir, "market_news", 32, False, True)


def _quarters(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return (o.groupBy("o_orderstatus", F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))
             .agg(F.avg("o_totalprice").alias("avg_p"), F.min("o_totalprice").alias("min_p"),
                  F.max("o_totalprice").alias("max_p"),
                  F.min(F.to_date("o_orderdate")).alias("first_d"), F.max(F.to_date("o_orderdate")).alias("last_d")))


def _per_status(df, item, feed, desc_key):
    g = df.groupBy("o_orderstatus").agg(F.array_sort(F.collect_list(F.struct(desc_key.alias("_k"), item.alias("x")))).alias("a"))
    return _landing(g, feed, F.col("o_orderstatus"), F.to_json(F.transform("a", lambda s: s["x"])))


def landing_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earnings responses: per order status, one item per quarter, newest first."""
    qd = F.make_date("y", F.col("q") * 3 - 2, F.lit(1))
    item = F.struct(F.col("avg_p").alias("actual"), F.col("min_p").alias("estimate"),
                    F.date_format(qd, "yyyy-MM-dd").alias("period"), F.col("q").alias("quarter"),
                    F.col("y").alias("year"))
    return _per_status(_quarters(spark, sf_dir), item, "earnings", -(F.col("y") * 10 + F.col("q")))


def landing_dividend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dividend responses: per order status, one record per quarter, newest first."""
    qd = F.make_date("y", F.col("q") * 3 - 2, F.lit(1))
    item = F.struct(F.col("avg_p").alias("amount"), F.col("max_p").alias("adjustedAmount"),
                    F.date_format(qd, "yyyy-MM-dd").alias("declarationDate"),
                    F.date_format("first_d", "yyyy-MM-dd").alias("exDate"),
                    F.date_format("last_d", "yyyy-MM-dd").alias("payDate"))
    return _per_status(_quarters(spark, sf_dir), item, "dividend", -(F.col("y") * 10 + F.col("q")))


def landing_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation responses: per order status, monthly counts by order
    priority (1..5 -> strongBuy, buy, hold, sell, strongSell), newest first."""
    o = read(spark, sf_dir, "orders")
    pr = F.substring("o_orderpriority", 1, 1)
    m = (o.groupBy("o_orderstatus", F.trunc(F.to_date("o_orderdate"), "month").alias("m"))
          .agg(*[F.sum((pr == str(i)).cast("int")).alias(n) for i, n in
                 enumerate(["strongBuy", "buy", "hold", "sell", "strongSell"], 1)]))
    item = F.struct("buy", "hold", "sell", "strongBuy", "strongSell",
                    F.date_format("m", "yyyy-MM-dd").alias("period"))
    return _per_status(m, item, "recommendation", -F.unix_date("m"))


def landing_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financials responses: per brand, one report per ship year, newest first."""
    li = read(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    y = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
           .groupBy("p_brand", F.year("l_shipdate").alias("y"))
           .agg(F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e")))
    item = F.struct(F.col("y").alias("year"),
                    F.date_format("s", "yyyy-MM-dd HH:mm:ss").alias("startDate"),
                    F.date_format("e", "yyyy-MM-dd HH:mm:ss").alias("endDate"))
    g = y.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("_k"), item.alias("x")))).alias("a"))
    body = F.to_json(F.struct(F.transform("a", lambda s: s["x"]).alias("data")))
    return _landing(g, "financials", F.col("p_brand"), body)


def landing_insider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insider responses: per supplier and ship month, its line items newest first. Only the sort
    keys are collected, which every field of an item follows from."""
    li = read(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    keys = F.struct((-F.unix_date(d)).alias("k0"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
                    F.col("l_partkey").alias("k3"), F.col("l_quantity").alias("k4"), F.col("l_returnflag").alias("k5"))

    def item(x: Column) -> Column:
        day = F.date_from_unix_date(-x["k0"]).cast("string")
        return F.struct(x["k1"].cast("string").alias("name"), x["k3"].alias("share"), x["k4"].cast("bigint").alias("change"),
                        day.alias("filingDate"), day.alias("transactionDate"), x["k5"].alias("transactionCode"))

    g = li.groupBy("l_suppkey", F.trunc(d, "month").alias("m")).agg(F.sort_array(F.collect_list(keys)).alias("a"))
    body = F.to_json(F.struct(F.transform("a", item).alias("data")))
    return _landing(g, "insider", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), body)


def landing_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Social responses: per event type and day; reddit from even users,
    twitter from odd users; a side without events is an empty list."""
    ev = read(spark, sf_dir, "events")
    cols = []
    for side, par in (("reddit", 0), ("twitter", 1)):
        mine = (F.col("user_id") % 2) == par
        cols += [F.sum(mine.cast("long")).alias(f"{side}_n"),
                 F.sum((mine & (F.col("value") >= 50)).cast("long")).alias(f"{side}_pos"),
                 F.sum((mine & (F.col("value") < 50)).cast("long")).alias(f"{side}_neg"),
                 F.avg(F.when(mine, F.col("value"))).alias(f"{side}_score")]
    g = ev.groupBy(F.col("event_type").alias("sym"), F.to_date("ts").alias("d")).agg(*cols)
    empty = F.array().cast(T.ArrayType(T.StructType([
        T.StructField("mention", T.LongType()), T.StructField("positiveMention", T.LongType()),
        T.StructField("negativeMention", T.LongType()), T.StructField("score", T.DoubleType())])))
    sides = [F.when(F.col(f"{s}_n") > 0, F.array(F.struct(
        F.col(f"{s}_n").alias("mention"), F.col(f"{s}_pos").alias("positiveMention"),
        F.col(f"{s}_neg").alias("negativeMention"), F.col(f"{s}_score").alias("score")))).otherwise(empty).alias(s)
        for s in ("reddit", "twitter")]
    return _landing(g, "social", F.col("sym"), F.to_json(F.struct(*sides)), batch_id_of(F.col("d")),
                    F.col("d").cast("timestamp"))


def landing_ipo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPO calendar responses: parts in key ranges of 50."""
    p = read(spark, sf_dir, "part")
    item = F.struct(F.col("p_partkey").alias("_k"), F.struct(
        F.col("p_brand").alias("exchange"), F.col("p_name").alias("name"),
        F.col("p_size").cast("bigint").alias("numberOfShares"),
        F.col("p_retailprice").cast("string").alias("price"), F.col("p_type").alias("status"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        (F.col("p_size") * F.col("p_retailprice")).alias("totalSharesValue")).alias("x"))
    g = p.groupBy(F.floor(F.col("p_partkey") / 50).alias("g")).agg(F.array_sort(F.collect_list(item)).alias("a"))
    body = F.to_json(F.struct(F.transform("a", lambda s: s["x"]).alias("ipoCalendar")))
    return _landing(g, "ipo", F.lit(None), body)


def landing_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that are not JSON: raw web pages landed as profile bodies."""
    pg = read(spark, sf_dir, "pages")
    return _landing(pg, "profile", F.col("page_id"), F.col("html"))


def landing_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with more keys than the feeds read. Insider responses per supplier and ship year with a
    price (a number, text on the 7th lines), a nested filing and the symbol in the body; and the quote
    responses of B5, of which those from event properties hold other keys only."""
    li = read(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    text = F.col("l_linenumber") == 7
    base = F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("name"), F.col("l_partkey").alias("share"),
                              F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).alias("filing")))
    shown = F.when(text, F.concat(F.lit('"'), cents.cast("string"), F.lit('"'))).otherwise(cents.cast("string"))
    item = F.concat(F.lit('{"price":'), shown, F.lit(","), F.expr("substring(base, 2)"))
    g = (li.withColumn("base", base).withColumn("item", item)
           .groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy").alias("y")).agg(F.array_sort(F.collect_list("item")).alias("a")))
    symbol = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    body = F.concat(F.lit('{"symbol":"'), symbol, F.lit('","data":['), F.array_join("a", ","), F.lit("]}"))
    wide = _landing(g, "insider", symbol, body, F.concat(F.col("y"), F.lit("0101_000000")))
    return wide.unionByName(landing_quote(spark, sf_dir))


LANDING_BUILDERS = {
    "quote": landing_quote, "candle": landing_candle, "profile": landing_profile,
    "company_news": landing_company_news, "earnings": landing_earnings,
    "financials": landing_financials, "insider": landing_insider,
    "recommendation": landing_recommendation, "social": landing_social,
    "dividend": landing_dividend, "market_news": landing_market_news, "ipo": landing_ipo,
}


def landing_all(spark: SparkSession, sf_dir: str, junk: bool = True) -> DataFrame:
    out = None
    for fn in LANDING_BUILDERS.values():
        df = fn(spark, sf_dir)
        out = df if out is None else out.unionByName(df)
    return out.unionByName(landing_junk(spark, sf_dir)) if junk else out
