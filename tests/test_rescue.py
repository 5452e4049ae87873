"""Keys that the normalizers do not read."""

import datetime as dt
import json

from marketframe.sources import feeds as FD
from marketframe.sources import rescue as R

T0 = dt.datetime(2024, 1, 1)


def landing(spark, *rows):
    return spark.createDataFrame([(f, "S", T0, b, p) for f, b, p in rows], FD.LANDING_SCHEMA)


def fields(df):
    from pyspark.sql import functions as F
    return {(r.feed, r.path, r.pos, r.key, r.v) for r in
            R.rescued_fields(df).select("feed", "path", "pos", "key", F.to_json("value").alias("v")).collect()}


def test_unread_keys_of_bodies_and_items(spark):
    df = landing(
        spark, ("quote", "b1", '{"c": 1.5, "t": 99, "x": {"deep": [1, null]}}'), ("quote", "b1", '{"c": 1}'),
        ("company_news", "b1", '[{"headline": "h", "id": 7}, {"id": null}, {"headline": "k"}]'),
        ("financials", "b1", '{"symbol": "S", "data": [{"year": 1, "report": {"ic": [{"v": 3}]}}, {"year": 2}]}'),
        ("social", "b1", '{"reddit": [{"mention": 1, "at": "noon"}], "twitter": [], "symbol": "S"}'),
        ("earnings", "b1", '{"not": "a list"}'), ("profile", "b1", "junk{"), ("dividend", "b1", None), ("ipo", "b1", "[]"))
    assert fields(df) == {
        ("quote", "$", None, "t", "99"), ("quote", "$", None, "x", '{"deep":[1,null]}'),
        ("company_news", "$[*]", 0, "id", "7"), ("company_news", "$[*]", 1, "id", "null"),
        ("financials", "$", None, "symbol", '"S"'), ("financials", "$.data[*]", 0, "report", '{"ic":[{"v":3}]}'),
        ("social", "$", None, "symbol", '"S"'), ("social", "$.reddit[*]", 0, "at", '"noon"')}
    whole = R.rescued(df).where("feed = 'quote'").selectExpr("to_json(rescued) AS j").collect()
    assert [json.loads(r.j) for r in whole] == [{"t": 99, "x": {"deep": [1, None]}}]


def test_drift_shows_new_keys_and_changed_types(spark):
    df = landing(spark, ("quote", "b1", '{"c": 1, "t": 1}'), ("quote", "b2", '{"c": 1, "t": 2}'),
                 ("quote", "b3", '{"c": 1, "t": "noon", "n": [1]}'), ("quote", "b3", '{"c": 1, "t": 3}'))
    got = sorted(((r.batch_id, r.key, r.type, r.rows, r.before) for r in R.schema_drift(R.rescued_fields(df, ["quote"])).collect()),
                 key=repr)
    assert got == [("b1", "t", "BIGINT", 1, None), ("b2", "t", "BIGINT", 1, "BIGINT"), ("b3", "n", "ARRAY<BIGINT>", 1, None),
                   ("b3", "t", "VARIANT", 2, "BIGINT")]


def test_known_keys_are_those_of_the_normalizers():
    assert set(R.READ) == set(FD.FEED_TABLES)
