"""Dashboard queries and status semantics."""

import datetime as dt

from pyspark.sql import functions as F

from marketframe.operators import views as V
from marketframe.streaming.streams import status_latest


def test_status_last_write_per_field(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        ("data_clean", "status", "processing", t, 1), ("data_clean", "message", "start", t, 1),
        ("data_clean", "status", "completed", t, 2),          # same ts, later seq wins
        ("data_ingest", "status", "error", t, 1)], "service string, field string, value string, ts timestamp, seq long")
    latest = {(r.service, r.field): r.value for r in status_latest(log).collect()}
    assert latest[("data_clean", "status")] == "completed"
    assert latest[("data_clean", "message")] == "start"       # field missing in the later update lingers
    board = {r.service: r for r in V.status_board(status_latest(log)).collect()}
    assert board["data_clean"].color == "green" and board["data_clean"].label == "Data Clean"
    assert board["data_ingest"].color == "red"


def test_latest_series_and_prefer(spark):
    df = spark.createDataFrame([("A", "b1", 1.0), ("A", "b2", 2.0), ("B", "b1", 3.0)],
                               "symbol string, batch_id string, close double")
    got = sorted((r.symbol, r.batch_id) for r in V.latest_series(df).collect())
    assert got == [("A", "b2"), ("B", "b1")]                    # B's newest batch containing it
    raw = df.withColumn("current_price", F.col("close"))
    empty = raw.where("false")
    assert {r.batch_id for r in V.prefer_processed(empty, raw).collect()} == {"b2"}   # no processed -> raw
    proc = raw.where("batch_id = 'b1'").withColumn("sentiment", F.lit("Bullish"))
    assert {r.batch_id for r in V.prefer_processed(proc, raw).collect()} == {"b1"}    # processed wins


def test_sentiment_and_bars(spark):
    df = spark.createDataFrame([("A", 1.0, "Bullish"), ("B", -1.0, "Odd"), ("C", None, None)],
                               "symbol string, change_percent double, sentiment string")
    counts = {r.sentiment: (r["count"], r.color) for r in V.sentiment_counts(df).collect()}
    assert counts == {"Bullish": (1, "lightgreen"), "Odd": (1, "gray")}
    colors = {r.symbol: r.color for r in V.change_bars(df).collect()}
    assert colors == {"A": "green", "B": "red", "C": "red"}


def test_indicator_latest_skips_all_null(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, None), ("A", dt.date(2024, 1, 2), None, None)],
                               "symbol string, date date, sma_5 double, rsi double")
    out = V.indicator_latest(df).collect()
    assert [(r.indicator, r.label, r.value) for r in out] == [("sma_5", "Sma 5", None)]  # last value kept even if null


def test_chart_series_and_flags(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 75.0)],
                               "symbol string, date date, open double, high double, low double, close double, rsi double")
    series = {r.series for r in V.chart_series(df).collect()}
    assert series == {"open", "high", "low", "close", "rsi"}
    assert V.rsi_flags(df).first().rsi_flag == "overbought"


def test_table_without_symbol_is_one_series(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "date date, sma_5 double")
    assert V.indicator_latest(df).first().symbol == "Stock"


def test_quote_chart_series(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 9), 10.0), ("A", dt.datetime(2024, 1, 1, 10), None)],
                               "symbol string, timestamp timestamp, current_price double")
    rows = V.chart_series(df).collect()
    assert [(r.series, r.value) for r in rows] == [("current_price", 10.0)]    # nulls dropped
