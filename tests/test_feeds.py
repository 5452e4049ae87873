"""Feed normalizers on hand-written payloads: guards, caps, datetimes, quarantine."""

import json

from marketframe.sources import bindings as B
from marketframe.sources import feeds as FD
from tests.test_plans import physical


def landing(spark, feed, payloads, symbol="AAA"):
    rows = [(feed, symbol, None, "20240101_000000", p) for p in payloads]
    return spark.createDataFrame(rows, FD.LANDING_SCHEMA)


def test_quote_key_presence(spark):
    out = FD.normalize_quote(landing(spark, "quote", ['{"c": null}', "{}", '{"c": 1.5, "pc": 1.0}'])).collect()
    assert sorted((r.current_price is None, r.previous_close) for r in out) == [(False, 1.0), (True, None)]


def test_social_lists(spark):
    pls = ['{"reddit": [], "twitter": [{"mention": 3, "score": 0.5}]}',   # empty list -> 0
           '{"reddit": [{"mention": 1}]}',                                   # twitter missing -> dropped
           '{"reddit": null, "twitter": []}']                                # null list -> 0
    out = FD.normalize_social(landing(spark, "social", pls)).collect()
    assert len(out) == 2
    first = [r for r in out if r.twitter_mention == 3][0]
    assert first.reddit_mention == 0 and first.reddit_score == 0.0
    assert first.twitter_positive_mention is None          # missing field in element 0 -> null
    assert first.twitter_score == 0.5


def news(n):
    return json.dumps([{"headline": f"h{i}", "datetime": i} for i in range(n)])


def test_nothing_is_cut_unless_asked(spark):
    recs = json.dumps([{"buy": i, "period": "2024-01-01"} for i in range(13)])
    fin = json.dumps({"data": [{"year": 2000 + i} for i in range(6)]})
    ins = json.dumps({"data": [{"name": f"p{i}", "change": i} for i in range(21)]})
    for feed, fn, payload, cap, n in (
            ("company_news", FD.normalize_company_news, news(11), FD.CAP_COMPANY_NEWS, 11),
            ("market_news", FD.normalize_market_news, news(25), FD.CAP_MARKET_NEWS, 25),
            ("recommendation", FD.normalize_recommendation, recs, FD.CAP_RECOMMENDATIONS, 13),
            ("financials", FD.normalize_financials, fin, FD.CAP_FINANCIALS, 6),
            ("insider", FD.normalize_insider, ins, FD.CAP_INSIDER, 21)):
        land = landing(spark, feed, [payload])
        assert fn(land).count() == n and fn(land, cap=cap).count() == cap < n
    assert FD.normalize_company_news(landing(spark, "company_news", [news(0)])).count() == 0
    f = FD.normalize_financials(landing(spark, "financials", [fin]), cap=5).collect()
    assert [r.year for r in f] == [2000, 2001, 2002, 2003, 2004] and f[0].frequency == "annual"


def test_fractional_counts_survive_and_bad_types_are_reported(spark):
    ins = json.dumps({"data": [{"name": "p", "share": 100.5, "change": -1500.0}]})
    r = FD.normalize_insider(landing(spark, "insider", [ins])).first()
    assert (r.share, r.change) == (100.5, -1500.0)
    assert FD.quarantine(landing(spark, "insider", [ins])).count() == 0
    ipo = json.dumps({"ipoCalendar": [{"numberOfShares": 12.5}]})
    assert FD.normalize_ipo(landing(spark, "ipo", [ipo])).first().number_of_shares == 12.5
    for feed, bad in (("insider", {"data": [{"share": "many"}]}), ("quote", {"c": "n/a"}),
                      ("earnings", [{"actual": 1.0}, {"quarter": "Q1"}]), ("social", {"reddit": [{"mention": "x"}], "twitter": []})):
        got = FD.quarantine(landing(spark, feed, [json.dumps(bad)])).collect()
        assert [r.reason for r in got] == ["bad_type"], feed
    for feed, good in (("quote", {"c": None}), ("social", {"reddit": [], "twitter": []}), ("profile", {"name": "n"})):
        assert FD.quarantine(landing(spark, feed, [json.dumps(good)])).count() == 0


def test_news_order_and_datetime(spark):
    pl = json.dumps([{"headline": "a", "datetime": 0}, {"headline": "b"},
                     {"headline": "c", "datetime": 1700000000}])
    out = FD.normalize_company_news(landing(spark, "company_news", [pl])).collect()
    assert [r.headline for r in out] == ["a", "b", "c"]
    assert out[0].datetime is None and out[1].datetime is None and out[2].datetime is not None


def test_candle_guard_ragged_and_quarantine(spark):
    ok = json.dumps({"s": "ok", "t": [86400, 172800], "o": [1.0, 2.0], "h": [1, 2], "l": [1, 2],
                     "c": [1.5, 2.5], "v": [10, 20]})
    ragged = json.dumps({"s": "ok", "t": [86400, 172800], "o": [1.0], "h": [1], "l": [1], "c": [1.5], "v": [10]})
    nodata = json.dumps({"s": "no_data"})
    land = landing(spark, "candle", [ok, ragged, nodata, "<html>", "", None])
    bars = FD.normalize_candle(land).collect()
    assert len(bars) == 4                                    # ragged row kept, padded with null
    assert sum(1 for b in bars if b.close is None) == 1
    assert str(sorted(b.date for b in bars)[0]) == "1970-01-02"
    q = sorted((r.reason) for r in FD.quarantine(land).collect())
    assert q == ["empty_body", "empty_body", "malformed_json", "ragged_candle"]


def test_list_guards(spark):
    assert FD.normalize_earnings(landing(spark, "earnings", ["[]", '{"a": 1}', '[{"actual": 1.0, "period": "2024-03-31"}]'])).count() == 1
    assert FD.normalize_profile(landing(spark, "profile", ["{}", '{"name": "X"}'])).count() == 1
    assert FD.normalize_ipo(landing(spark, "ipo", ['{"ipoCalendar": [{"name": "N"}]}', "{}"])).count() == 1
    div = FD.normalize_dividend(landing(spark, "dividend", ['[{"amount": 0.5, "exDate": "2024-02-01"}]'])).first()
    assert str(div.ex_dividend_date) == "2024-02-01"


def test_ingest_summary(spark):
    q = FD.normalize_quote(landing(spark, "quote", ['{"c": 1}']))
    n = FD.normalize_company_news(landing(spark, "company_news", [news(3)]))
    s = FD.ingest_summary({"quotes": q, "company_news": n}, quotes=q).first()
    assert s.data_summary["quotes"] == 1 and s.data_summary["news"] == 3 and s.data_summary["dividends"] == 0
    assert s.files_created == 2 and s.symbols == ["AAA"]


def test_no_data_warnings(spark):
    rows = [("quote", '{}'), ("quote", '{"c": 1}'), ("candle", '{"s": "no_data"}'),
            ("company_news", "[]"), ("company_news", news(2)), ("profile", "<html>"),
            ("financials", '{"data": []}'), ("social", '{"reddit": []}')]
    land = spark.createDataFrame([(f, "AAA", None, "b", p) for f, p in rows], FD.LANDING_SCHEMA)
    got = sorted(r.feed for r in FD.no_data(land).collect())
    assert got == ["candle", "company_news", "financials", "quote", "social"]   # html is quarantined, not here


def test_insider_payloads_are_parsed_once(spark):
    """Neither lists that explode drops anyway nor text built before the shuffle."""
    rows = [("insider", "A", None, "b", p) for p in ('{"data":[{"name":"x","share":1}]}', '{"data":[]}', "{}", "no", None)]
    landing = spark.createDataFrame(rows, FD.LANDING_SCHEMA).repartition(2)
    for normalize in (FD.normalize_insider, FD.normalize_financials):
        assert physical(normalize(landing)).count("from_json(") == 1
    assert [r.person_name for r in FD.normalize_insider(landing).collect()] == ["x"]
    assert "date_format" not in physical(B.landing_insider(spark, "/root/testdata/sf0.001"))
