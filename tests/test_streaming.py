"""Streaming jobs: exactly-once pickup, equality with batch, dedup, events."""

import datetime as dt
import shutil

from pyspark.sql import functions as F

from marketframe.operators.report import clean_quotes
from marketframe.sources import bindings as B
from marketframe.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def test_stream_clean_twice_equals_batch(spark, tmp_shared):
    q = B.quotes_events(spark, SF)
    src, dst, ck = f"{tmp_shared}/src", f"{tmp_shared}/dst", f"{tmp_shared}/ck"
    q.where(F.col("batch_id") < "20240115").write.partitionBy("batch_id").parquet(src)
    ST.stream_clean(spark, src, dst, ck, q.schema, clean_quotes).awaitTermination()
    first = spark.read.parquet(dst).count()
    ST.stream_clean(spark, src, dst, ck, q.schema, clean_quotes).awaitTermination()
    assert spark.read.parquet(dst).count() == first             # nothing new: nothing added
    q.where(F.col("batch_id") >= "20240115").write.mode("append").partitionBy("batch_id").parquet(src)
    ST.stream_clean(spark, src, dst, ck, q.schema, clean_quotes).awaitTermination()
    got = spark.read.parquet(dst)
    assert got.count() == q.count()
    assert got.where("sentiment IS NOT NULL").count() == clean_quotes(q).where("sentiment IS NOT NULL").count()


def test_stream_dedup(spark, tmp_shared):
    ev = B.read(spark, SF, "events").select("event_id", "ts", "value")
    ev.unionByName(ev.limit(50)).write.parquet(f"{tmp_shared}/src")
    s = spark.readStream.schema(ev.schema).parquet(f"{tmp_shared}/src")
    q = (ST.stream_dedup(s, ["event_id"], "ts").writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_shared}/ck").trigger(availableNow=True).start(f"{tmp_shared}/dst"))
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_shared}/dst").count() == ev.count()


def test_event_filter_accepts_both_names_and_skips_junk(spark):
    rows = [('{"event": "comprehensive_data_ingested", "files_created": 3}',),
            ('{"event": "data_ingested"}',), ('{"event": "data_processed"}',), ("not json",)]
    msgs = spark.createDataFrame(rows, "message string")
    got = sorted(r.event for r in ST.event_filter(msgs).collect())
    assert got == ["comprehensive_data_ingested", "data_ingested"]


def test_emit_events(spark):
    summ = spark.createDataFrame([(dt.datetime(2024, 1, 1), 2, 95.5)],
                                 "timestamp timestamp, total_files_processed long, average_quality_score double")
    e = ST.emit_events(summ).first()
    assert e.event == "data_processed" and e.files_processed == 2 and '"files_processed":2' in e.message


def test_status_stream_update_mode(spark, tmp_shared):
    t = dt.datetime(2024, 1, 1)
    schema = "service string, field string, value string, ts timestamp, seq long"
    spark.createDataFrame([("ingest", "status", "fetching", t, 1), ("ingest", "status", "completed", t, 2)],
                          schema).write.parquet(f"{tmp_shared}/log/a")
    s = spark.readStream.schema(schema).parquet(f"{tmp_shared}/log/*")
    q = (ST.status_latest(s).writeStream.outputMode("update").format("memory").queryName("status_view")
         .option("checkpointLocation", f"{tmp_shared}/ck").start())
    q.processAllAvailable()
    spark.createDataFrame([("ingest", "message", "done", t, 3)], schema).write.parquet(f"{tmp_shared}/log/b")
    q.processAllAvailable()
    q.stop()
    rows = spark.sql("SELECT field, value FROM status_view").collect()
    latest = {}
    for r in rows:
        latest[r.field] = r.value
    assert latest == {"status": "completed", "message": "done"}


def test_event_stream_from_json_lines(spark, tmp_shared):
    lines = ['{"event": "comprehensive_data_ingested", "files_created": 3}', "garbage", '{"event": "other"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_shared}/ev")
    q = (ST.event_stream(spark, f"{tmp_shared}/ev").writeStream.format("memory").queryName("ingest_events")
         .option("checkpointLocation", f"{tmp_shared}/ck2").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT event, files_created FROM ingest_events").collect()
    assert [(r.event, r.files_created) for r in got] == [("comprehensive_data_ingested", 3)]


def test_stream_clean_batch_split_over_micro_batches(spark, tmp_shared):
    q = B.quotes_events(spark, SF).where(F.col("batch_id") == "20240105_000000")
    src, dst, ck = f"{tmp_shared}/src", f"{tmp_shared}/dst", f"{tmp_shared}/ck"
    q.where("symbol < 'm'").write.partitionBy("batch_id").parquet(src)
    ST.stream_clean(spark, src, dst, ck, q.schema, clean_quotes).awaitTermination()
    q.where("symbol >= 'm'").write.mode("append").partitionBy("batch_id").parquet(src)   # late file, same batch
    ST.stream_clean(spark, src, dst, ck, q.schema, clean_quotes).awaitTermination()
    assert spark.read.parquet(dst).count() == q.count() == 5


def test_stream_ingest(spark, tmp_shared):
    land = B.landing_quote(spark, SF).unionByName(B.landing_candle(spark, SF))
    land.where("feed = 'candle'").write.parquet(f"{tmp_shared}/land/a")
    q = ST.stream_ingest(spark, f"{tmp_shared}/land/*", f"{tmp_shared}/out", f"{tmp_shared}/ck")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_shared}/out/bars").count() == 150
    land.where("feed = 'quote'").write.parquet(f"{tmp_shared}/land/b")
    ST.stream_ingest(spark, f"{tmp_shared}/land/*", f"{tmp_shared}/out", f"{tmp_shared}/ck").awaitTermination()
    assert spark.read.parquet(f"{tmp_shared}/out/quotes").count() == 150
    assert spark.read.parquet(f"{tmp_shared}/out/bars").count() == 150      # not reprocessed


def test_stream_ingest_keeps_a_batch_split_over_runs(spark, tmp_shared):
    land = B.landing_quote(spark, SF).where("batch_id = '20240105_000000' AND json_object_keys(payload)[0] = 'c'")
    assert land.count() == 5
    run = lambda ck: ST.stream_ingest(spark, f"{tmp_shared}/land/*", f"{tmp_shared}/out", ck).awaitTermination()
    land.where("symbol < 'm'").write.parquet(f"{tmp_shared}/land/a")
    run(f"{tmp_shared}/ck")
    shutil.copytree(f"{tmp_shared}/ck", f"{tmp_shared}/ck-before")
    land.where("symbol >= 'm'").write.parquet(f"{tmp_shared}/land/b")
    run(f"{tmp_shared}/ck")
    assert spark.read.parquet(f"{tmp_shared}/out/quotes").count() == 5
    run(f"{tmp_shared}/ck-before")     # the second epoch once more, as after a crash before its commit
    assert spark.read.parquet(f"{tmp_shared}/out/quotes").count() == 5
    assert spark.read.parquet(f"{tmp_shared}/out/landing").count() == 5


def test_event_quarantine(spark):
    rows = [('{"event": "data_ingested"}',), ("not json",), ("",), (None,), ('{"a": 1}',)]
    msgs = spark.createDataFrame(rows, "message string")
    assert sorted(r.reason for r in ST.event_quarantine(msgs).collect()) == [
        "empty_message", "empty_message", "malformed_json", "no_event"]


def test_exact_stream_dedup(spark, tmp_shared):
    ev = B.read(spark, SF, "events").select("event_id", "ts")
    ev.write.parquet(f"{tmp_shared}/src/a")
    s = spark.readStream.schema(ev.schema).parquet(f"{tmp_shared}/src/*")
    start = lambda: (ST.stream_dedup_exact(s, ["event_id"]).writeStream.format("parquet")
                     .option("checkpointLocation", f"{tmp_shared}/ck").trigger(availableNow=True).start(f"{tmp_shared}/dst"))
    start().awaitTermination()
    ev.limit(50).write.parquet(f"{tmp_shared}/src/b")     # copies that come much later
    start().awaitTermination()
    assert spark.read.parquet(f"{tmp_shared}/dst").count() == ev.count()
