"""Feed normalizers: landed JSON payloads -> flat typed tables.

Input of every normalizer is a landing table
``(feed STRING, symbol STRING, fetched_at TIMESTAMP, batch_id STRING, payload STRING)``
holding one vendor response per row (the HTTP fetch itself is not part of the
engine). Each normalizer is ``where(feed) -> validity guard -> from_json ->
slice cap -> posexplode/inline -> renaming select``: row-local, no shuffle,
so it scales with the landing table. Guards test key *presence* the way the
reference does (a present key with a null value passes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import epoch_to_ts, let

LANDING_SCHEMA = T.StructType([
    T.StructField("feed", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("payload", T.StringType()),
])

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


# Payload schemas: vendor keys as the reference reads them; types are ours.
QUOTE = _struct(c=D, h=D, l=D, o=D, pc=D, d=D, dp=D)
CANDLE = _struct(s=S, t=T.ArrayType(L), o=T.ArrayType(D), h=T.ArrayType(D), l=T.ArrayType(D),
                 c=T.ArrayType(D), v=T.ArrayType(D))
PROFILE = _struct(name=S, country=S, currency=S, exchange=S, finnhubIndustry=S, ipo=S,
                  marketCapitalization=D, shareOutstanding=D, logo=S, weburl=S, phone=S)
NEWS_ITEM = _struct(headline=S, summary=S, url=S, datetime=L, source=S, category=S, image=S,
                    sentiment=S, related=S)
EARNING = _struct(actual=D, estimate=D, period=S, quarter=I, year=I)
FINANCIALS = _struct(data=T.ArrayType(_struct(year=I, quarter=I, form=S, startDate=S, endDate=S,
                                              filedDate=S, acceptedDate=S)))
INSIDER = _struct(data=T.ArrayType(_struct(name=S, share=D, change=D, filingDate=S,
                                           transactionDate=S, transactionCode=S)))
RECOMMENDATION = _struct(buy=I, hold=I, sell=I, strongBuy=I, strongSell=I, period=S)
SOCIAL_ITEM = _struct(mention=L, positiveMention=L, negativeMention=L, score=D)
SOCIAL = _struct(reddit=T.ArrayType(SOCIAL_ITEM), twitter=T.ArrayType(SOCIAL_ITEM))
DIVIDEND = _struct(amount=D, adjustedAmount=D, declarationDate=S, exDate=S, payDate=S,
                   recordDate=S, frequency=S)
IPO = _struct(ipoCalendar=T.ArrayType(_struct(date=S, exchange=S, name=S, numberOfShares=D,
                                              price=S, status=S, symbol=S, totalSharesValue=D)))

# The list caps that the reference applies to a response, in payload
# order. Stored payloads are read whole unless a caller passes one of these as ``cap``.
CAP_COMPANY_NEWS, CAP_FINANCIALS, CAP_INSIDER, CAP_RECOMMENDATIONS, CAP_MARKET_NEWS = 10, 5, 20, 12, 20

# The 12 feed names and the table each one fills.
FEED_TABLES = {
    "quote": "quotes", "candle": "bars", "profile": "profiles", "company_news": "company_news",
    "earnings": "earnings", "financials": "financials", "insider": "insider_transactions",
    "recommendation": "analyst_recommendations", "social": "social_sentiment",
    "dividend": "dividends", "market_news": "market_news", "ipo": "ipo_calendar",
}
# The count keys of the reference's ingest event, in its order.
SUMMARY_KEYS = {"quote": "quotes", "candle": "historical", "profile": "profiles",
                "company_news": "news", "earnings": "earnings", "financials": "financials",
                "insider": "insider", "recommendation": "recommendations", "social": "sentiment",
                "dividend": "dividends", "market_news": "market_news", "ipo": "ipo_calendar"}


def _feed(landing: DataFrame, feed: str) -> DataFrame:
    return landing.where(F.col("feed") == feed)


def has_key(payload: Column, key: str) -> Column:
    """True when the JSON object has ``key`` (even with a null value)."""
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def non_empty_list(payload: Column) -> Column:
    """True when the JSON is a list with at least one element."""
    return F.coalesce(F.json_array_length(payload) > 0, F.lit(False))


def to_date_lenient(c: Column) -> Column:
    """'yyyy-MM-dd...' text -> DATE; unparsable -> null (never raises)."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def to_ts_lenient(c: Column) -> Column:
    return F.try_to_timestamp(c)


def normalize_quote(landing: DataFrame) -> DataFrame:
    """quote -> quotes; kept when key ``c`` is present."""
    t = _feed(landing, "quote").where(has_key(F.col("payload"), "c"))
    p = F.from_json("payload", QUOTE)
    t = t.select("*", p.alias("p"))
    return t.select("symbol", F.col("p.c").alias("current_price"), F.col("p.h").alias("high_price"),
                    F.col("p.l").alias("low_price"), F.col("p.o").alias("open_price"),
                    F.col("p.pc").alias("previous_close"), F.col("p.d").alias("change"),
                    F.col("p.dp").alias("change_percent"), F.col("fetched_at").alias("timestamp"),
                    "batch_id")


def normalize_candle(landing: DataFrame) -> DataFrame:
    """candle arrays -> one bar per index of ``t`` when ``s == 'ok'``.
    Shorter o/h/l/c/v arrays give nulls (and the row is quarantined)."""
    t = (_feed(landing, "candle").select("symbol", "batch_id", F.from_json("payload", CANDLE).alias("p"))
                                 .where(F.col("p.s") == "ok"))
    t = t.select("symbol", "batch_id", "p", F.posexplode("p.t").alias("pos", "ts"))
    g = lambda k: F.get(F.col(f"p.{k}"), F.col("pos"))
    return t.select("symbol", F.to_date(F.timestamp_seconds("ts")).alias("date"),
                    g("o").alias("open"), g("h").alias("high"), g("l").alias("low"),
                    g("c").alias("close"), g("v").alias("volume"), "batch_id")


def normalize_profile(landing: DataFrame) -> DataFrame:
    """profile -> profiles; kept when key ``name`` is present."""
    t = _feed(landing, "profile").where(has_key(F.col("payload"), "name"))
    t = t.select("*", F.from_json("payload", PROFILE).alias("p"))
    return t.select("symbol", F.col("p.name").alias("name"), F.col("p.country").alias("country"),
                    F.col("p.currency").alias("currency"), F.col("p.exchange").alias("exchange"),
                    F.col("p.finnhubIndustry").alias("industry"), F.col("p.ipo").alias("ipo"),
                    F.col("p.marketCapitalization").alias("market_cap"),
                    F.col("p.shareOutstanding").alias("shares_outstanding"),
                    F.col("p.logo").alias("logo"), F.col("p.weburl").alias("weburl"),
                    F.col("p.phone").alias("phone"), F.col("fetched_at").alias("timestamp"), "batch_id")


def _first(arr: Column, cap: int | None) -> Column:
    """The first ``cap`` items in payload order, all by default."""
    return arr if cap is None else F.slice(arr, 1, cap)


def _news(landing: DataFrame, feed: str, cap: int | None) -> DataFrame:
    t = _feed(landing, feed).where(non_empty_list(F.col("payload")))
    arr = _first(F.from_json("payload", T.ArrayType(NEWS_ITEM)), cap)
    return t.select("symbol", "batch_id", F.posexplode(arr).alias("pos", "n"))


def normalize_company_news(landing: DataFrame, cap: int | None = None) -> DataFrame:
    """the news items in payload order (the first ``cap``); datetime 0/missing -> null."""
    t = _news(landing, "company_news", cap)
    return t.select("symbol", F.col("n.headline").alias("headline"), F.col("n.summary").alias("summary"),
                    F.col("n.url").alias("url"), epoch_to_ts(F.col("n.datetime")).alias("datetime"),
                    F.col("n.source").alias("source"), F.col("n.category").alias("category"),
                    F.col("n.image").alias("image"), F.col("n.sentiment").alias("sentiment"), "batch_id")


def normalize_market_news(landing: DataFrame, cap: int | None = None) -> DataFrame:
    """as company news with ``related``, without symbol and sentiment."""
    t = _news(landing, "market_news", cap)
    return t.select(F.col("n.headline").alias("headline"), F.col("n.summary").alias("summary"),
                    F.col("n.url").alias("url"), epoch_to_ts(F.col("n.datetime")).alias("datetime"),
                    F.col("n.source").alias("source"), F.col("n.category").alias("category"),
                    F.col("n.image").alias("image"), F.col("n.related").alias("related"), "batch_id")


def normalize_earnings(landing: DataFrame) -> DataFrame:
    """every earnings item of a non-empty list."""
    t = _feed(landing, "earnings").where(non_empty_list(F.col("payload")))
    t = t.select("symbol", "fetched_at", "batch_id",
                 F.explode(F.from_json("payload", T.ArrayType(EARNING))).alias("e"))
    return t.select("symbol", F.col("e.actual").alias("actual"), F.col("e.estimate").alias("estimate"),
                    to_date_lenient(F.col("e.period")).alias("period"), F.col("e.quarter").alias("quarter"),
                    F.col("e.year").alias("year"), F.col("fetched_at").alias("timestamp"), "batch_id")


def normalize_financials(landing: DataFrame, freq: str = "annual", cap: int | None = None) -> DataFrame:
    """the reports of ``data`` (the first ``cap``); scalar metadata per report."""
    t = _feed(landing, "financials").select("symbol", "batch_id", F.from_json("payload", FINANCIALS).alias("p"))
    t = t.select("symbol", "batch_id", F.explode(_first(F.col("p.data"), cap)).alias("r"))
    return t.select("symbol", F.lit(freq).alias("frequency"), F.col("r.year").alias("year"),
                    F.col("r.quarter").alias("quarter"), F.col("r.form").alias("form"),
                    to_ts_lenient(F.col("r.startDate")).alias("start_date"),
                    to_ts_lenient(F.col("r.endDate")).alias("end_date"),
                    to_ts_lenient(F.col("r.filedDate")).alias("filed_date"),
                    to_ts_lenient(F.col("r.acceptedDate")).alias("accepted_date"), "batch_id")


def normalize_insider(landing: DataFrame, cap: int | None = None) -> DataFrame:
    """the transactions of ``data`` (the first ``cap``); counts may be fractional."""
    t = _feed(landing, "insider").select("symbol", "batch_id", F.from_json("payload", INSIDER).alias("p"))
    t = t.select("symbol", "batch_id", F.explode(_first(F.col("p.data"), cap)).alias("x"))
    return t.select("symbol", F.col("x.name").alias("person_name"), F.col("x.share").alias("share"),
                    F.col("x.change").alias("change"),
                    to_date_lenient(F.col("x.filingDate")).alias("filing_date"),
                    to_date_lenient(F.col("x.transactionDate")).alias("transaction_date"),
                    F.col("x.transactionCode").alias("transaction_code"), "batch_id")


def normalize_recommendation(landing: DataFrame, cap: int | None = None) -> DataFrame:
    """the monthly recommendation records (the first ``cap``)."""
    t = _feed(landing, "recommendation").where(non_empty_list(F.col("payload")))
    arr = _first(F.from_json("payload", T.ArrayType(RECOMMENDATION)), cap)
    t = t.select("symbol", "batch_id", F.explode(arr).alias("r"))
    return t.select("symbol", F.col("r.buy").alias("buy"), F.col("r.hold").alias("hold"),
                    F.col("r.sell").alias("sell"), F.col("r.strongBuy").alias("strong_buy"),
                    F.col("r.strongSell").alias("strong_sell"),
                    to_date_lenient(F.col("r.period")).alias("period"), "batch_id")


def normalize_social(landing: DataFrame) -> DataFrame:
    """element 0 of ``reddit`` and ``twitter``; both keys must be present;
    an empty (or null) list gives 0, a missing field in element 0 gives null."""
    pl = F.col("payload")
    t = _feed(landing, "social").where(has_key(pl, "reddit") & has_key(pl, "twitter"))
    t = t.select("*", F.from_json("payload", SOCIAL).alias("p"))
    cols = []
    for src in ("reddit", "twitter"):
        arr = F.col(f"p.{src}")
        first = F.get(arr, 0)
        some = F.coalesce(F.size(arr), F.lit(0)) > 0
        for key, name, typ in (("mention", "mention", "bigint"), ("positiveMention", "positive_mention", "bigint"),
                               ("negativeMention", "negative_mention", "bigint"), ("score", "score", "double")):
            cols.append(F.when(some, first[key]).otherwise(F.lit(0)).cast(typ).alias(f"{src}_{name}"))
    return t.select("symbol", *cols, F.col("fetched_at").alias("timestamp"), "batch_id")


def normalize_dividend(landing: DataFrame) -> DataFrame:
    """every dividend record of a non-empty list."""
    t = _feed(landing, "dividend").where(non_empty_list(F.col("payload")))
    t = t.select("symbol", "batch_id", F.explode(F.from_json("payload", T.ArrayType(DIVIDEND))).alias("v"))
    return t.select("symbol", F.col("v.amount").alias("amount"),
                    F.col("v.adjustedAmount").alias("adjusted_amount"),
                    to_date_lenient(F.col("v.declarationDate")).alias("declaration_date"),
                    to_date_lenient(F.col("v.exDate")).alias("ex_dividend_date"),
                    to_date_lenient(F.col("v.payDate")).alias("payment_date"),
                    to_date_lenient(F.col("v.recordDate")).alias("record_date"),
                    F.col("v.frequency").alias("frequency"), "batch_id")


def normalize_ipo(landing: DataFrame) -> DataFrame:
    """every entry of ``ipoCalendar`` when the key is present."""
    t = _feed(landing, "ipo").where(has_key(F.col("payload"), "ipoCalendar"))
    t = t.select("batch_id", F.explode(F.from_json("payload", IPO)["ipoCalendar"]).alias("x"))
    return t.select(to_date_lenient(F.col("x.date")).alias("date"), F.col("x.exchange").alias("exchange"),
                    F.col("x.name").alias("name"), F.col("x.numberOfShares").alias("number_of_shares"),
                    F.col("x.price").alias("price"), F.col("x.status").alias("status"),
                    F.col("x.symbol").alias("symbol"), F.col("x.totalSharesValue").alias("total_shares_value"),
                    "batch_id")


NORMALIZERS = {
    "quote": normalize_quote, "candle": normalize_candle, "profile": normalize_profile,
    "company_news": normalize_company_news, "earnings": normalize_earnings,
    "financials": normalize_financials, "insider": normalize_insider,
    "recommendation": normalize_recommendation, "social": normalize_social,
    "dividend": normalize_dividend, "market_news": normalize_market_news, "ipo": normalize_ipo,
}


def normalize_all(landing: DataFrame) -> dict[str, DataFrame]:
    """Every feed's flat table, keyed by table name."""
    return {FEED_TABLES[f]: fn(landing) for f, fn in NORMALIZERS.items()}


# Payload type per feed, for the type check of ``quarantine``.
PAYLOADS: dict[str, T.DataType] = {
    "quote": QUOTE, "candle": CANDLE, "profile": PROFILE, "company_news": T.ArrayType(NEWS_ITEM),
    "earnings": T.ArrayType(EARNING), "financials": FINANCIALS, "insider": INSIDER,
    "recommendation": T.ArrayType(RECOMMENDATION), "social": SOCIAL, "dividend": T.ArrayType(DIVIDEND),
    "market_news": T.ArrayType(NEWS_ITEM), "ipo": IPO,
}


def _as_text(dt: T.DataType) -> T.DataType:
    """``dt`` with every scalar as text."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_as_text(dt.elementType))
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in dt.fields])
    return S


def _lost(raw: Column, typed: Column, dt: T.DataType) -> Column:
    """True where a value of the payload is there but did not fit its type."""
    if isinstance(dt, T.StringType):
        return F.lit(False)
    if isinstance(dt, T.ArrayType):
        pairs = F.arrays_zip(raw.alias("r"), typed.alias("t"))
        own = F.exists(pairs, lambda x: F.coalesce(_lost(x["r"], x["t"], dt.elementType), F.lit(False)))
        return (raw.isNotNull() & typed.isNull()) | F.coalesce(own, F.lit(False))
    if isinstance(dt, T.StructType):
        out = F.lit(False)
        for f in dt.fields:
            out = out | F.coalesce(_lost(raw[f.name], typed[f.name], f.dataType), F.lit(False))
        return out
    return raw.isNotNull() & typed.isNull()


def bad_type(feed: Column, payload: Column) -> Column:
    """True where a payload holds a non-null value that its column type cannot take."""
    def lost(dt: T.DataType) -> Column:  # each payload is parsed twice, however many fields are compared
        both = F.struct(F.from_json(payload, _as_text(dt)).alias("raw"), F.from_json(payload, dt).alias("typed"))
        return let(both, lambda x: _lost(x["raw"], x["typed"], dt))

    out = F.lit(False)
    for name, dt in PAYLOADS.items():
        out = F.when(feed == name, lost(dt)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def quarantine(landing: DataFrame) -> DataFrame:
    """landing rows that cannot be used as they are, with a reason: empty body,
    malformed JSON, a candle whose value arrays are shorter than ``t``, or a
    value that does not fit its column (``bad_type``; such a value reads as
    null). The other rows (and feeds) continue unaffected."""
    pl = F.col("payload")
    ragged = F.when(F.col("feed") == "candle", let(F.from_json(pl, CANDLE), lambda c: (c["s"] == "ok") & F.exists(
        F.array(*[F.coalesce(F.size(c[k]), F.lit(-1)) for k in "ohlcv"]), lambda n: n < F.size(c["t"]))))
    reason = (F.when(pl.isNull() | (F.trim(pl) == ""), F.lit("empty_body"))
               .when(F.try_parse_json(pl).isNull(), F.lit("malformed_json"))
               .when(ragged, F.lit("ragged_candle"))
               .when(bad_type(F.col("feed"), pl), F.lit("bad_type")))
    return (landing.select("feed", "symbol", "batch_id", "fetched_at", reason.alias("reason"))
                   .where(F.col("reason").isNotNull()))


def guard_passes(feed: Column, payload: Column) -> Column:
    """The reference's per-feed "data returned" test on a JSON payload."""
    p = payload
    candle_ok = F.from_json(p, CANDLE)["s"] == "ok"
    fin_ok = F.coalesce(F.size(F.from_json(p, FINANCIALS)["data"]) > 0, F.lit(False))
    ins_ok = F.coalesce(F.size(F.from_json(p, INSIDER)["data"]) > 0, F.lit(False))
    return (F.when(feed == "quote", has_key(p, "c"))
             .when(feed == "candle", F.coalesce(candle_ok, F.lit(False)))
             .when(feed == "profile", has_key(p, "name"))
             .when(feed == "financials", fin_ok)
             .when(feed == "insider", ins_ok)
             .when(feed == "social", has_key(p, "reddit") & has_key(p, "twitter"))
             .when(feed == "ipo", has_key(p, "ipoCalendar"))
             .when(feed.isin("company_news", "earnings", "recommendation", "dividend", "market_news"),
                   non_empty_list(p))
             .otherwise(F.lit(False)))


def no_data(landing: DataFrame) -> DataFrame:
    """Responses that parsed but carry no data for their feed (the
    reference's "no data returned" warnings): valid JSON failing the feed's
    guard. Row-local; malformed bodies are in ``quarantine`` instead."""
    pl = F.col("payload")
    valid = pl.isNotNull() & F.try_parse_json(pl).isNotNull()
    return (landing.where(valid & ~guard_passes(F.col("feed"), pl))
                   .select("feed", "symbol", "batch_id", "fetched_at"))


def ingest_counts(tables: dict[str, DataFrame], batch: str = "batch_id") -> DataFrame:
    """F18 (long form): rows per (batch, feed key) over the union of all feed
    tables - one grouped count, partial aggregation before the shuffle."""
    inv = {FEED_TABLES[f]: SUMMARY_KEYS[f] for f in FEED_TABLES}
    parts = [df.select(F.col(batch), F.lit(inv[name]).alias("feed")) for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(batch, "feed").agg(F.count(F.lit(1)).alias("rows"))


def ingest_summary(tables: dict[str, DataFrame], quotes: DataFrame | None = None,
                   batch: str = "batch_id") -> DataFrame:
    """per batch the 12-key count map, number of files created (non-empty
    feeds) and the fetched symbols. One row per batch; the map has 12 keys."""
    counts = ingest_counts(tables, batch)
    keys = list(SUMMARY_KEYS.values())
    per = counts.groupBy(batch).agg(
        *[F.coalesce(F.sum(F.when(F.col("feed") == k, F.col("rows"))), F.lit(0)).alias(k) for k in keys],
        F.count(F.lit(1)).alias("files_created"))
    out = per.select(batch, F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))]).alias("data_summary"),
                     "files_created")
    if quotes is not None:
        out = out.join(fetched_symbols(quotes, batch, as_list=True), batch, "left")
    return out


def fetched_symbols(quotes: DataFrame, batch: str = "batch_id", as_list: bool = False) -> DataFrame:
    """symbols whose quote succeeded, per batch. Long form by default;
    ``as_list`` gives the reference's sorted list (one entry per symbol)."""
    long = quotes.select(batch, "symbol").where(F.col("symbol").isNotNull()).distinct()
    if not as_list:
        return long
    return long.groupBy(batch).agg(F.array_sort(F.collect_list("symbol")).alias("symbols"))
