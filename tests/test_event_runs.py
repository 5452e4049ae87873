"""Cleaning on events, the status stream and exact stream dedup: replays change nothing."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from marketframe.session import materialize, staging
from marketframe.sources import bindings as B
from marketframe.sources import commits as C
from marketframe.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def messages(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def land(spark, raw, day):
    os.makedirs(raw, exist_ok=True)
    q = B.quotes_events(spark, SF).where(F.col("batch_id") == day).drop("batch_id")
    q.toPandas().to_csv(f"{raw}/stock_quotes_{day}.csv", index=False)


def test_events_start_one_cleaning_run_and_replays_none(spark, tmp_shared):
    raw, root, ck = f"{tmp_shared}/raw", f"{tmp_shared}/out", f"{tmp_shared}/ck"
    run = lambda ck: ST.clean_on_events(spark, f"{tmp_shared}/ev/*", raw, root, ck).awaitTermination()
    land(spark, raw, "20240103_000000")
    messages(spark, f"{tmp_shared}/ev/a", '{"event": "comprehensive_data_ingested"}', '{"event": "data_ingested"}', "garbage")
    run(ck)
    assert C.read(spark, root, "processed_quotes").count() == 5
    assert C.read(spark, root, "handled_events").count() == 2 and C.read(spark, root, "bad_events").count() == 1
    assert C.committed_runs(spark, root).where("job = 'clean'").count() == 1          # two events, one run
    shutil.copytree(ck, f"{tmp_shared}/ck-before")
    messages(spark, f"{tmp_shared}/ev/b", '{"event": "something_else"}')
    land(spark, raw, "20240104_000000")
    run(ck)
    assert C.read(spark, root, "processed_quotes").count() == 5                      # no ingest event, no run
    messages(spark, f"{tmp_shared}/ev/c", '{"event": "data_ingested"}')
    run(ck)
    assert C.read(spark, root, "processed_quotes").count() == 10
    before = [r.run_id for r in C.committed_runs(spark, root).orderBy("seq").collect()]
    shutil.rmtree(f"{ck}/commits")                                                   # as if the last epochs had not been noted
    shutil.copytree(f"{tmp_shared}/ck-before/commits", f"{ck}/commits")
    run(ck)
    after = [r.run_id for r in C.committed_runs(spark, root).where("job IN ('clean', 'events')").collect()]
    assert set(after) <= set(before) and C.read(spark, root, "events").count() == 2


def status(spark, path, *rows):
    spark.createDataFrame([(*r[:3], dt.datetime(2024, 1, 1) + dt.timedelta(hours=r[3]), r[4]) for r in rows],
                          ST.STATUS_SCHEMA).coalesce(1).write.parquet(path)


def test_status_stream_equals_status_latest(spark, tmp_shared):
    root, ck = f"{tmp_shared}/store", f"{tmp_shared}/ck"

    def run():
        log = spark.readStream.schema(ST.STATUS_SCHEMA).parquet(f"{tmp_shared}/log/*")
        ST.stream_status(log, root, ck).awaitTermination()
    now = lambda: {(r.service, r.field): r.value for r in C.read(spark, root, "status_current").collect()}
    status(spark, f"{tmp_shared}/log/a", ("ingest", "status", "fetching", 1, 0), ("ingest", "symbols", "5", 1, 1),
           ("clean", "status", "idle", 1, 0))
    run()
    status(spark, f"{tmp_shared}/log/b", ("ingest", "status", "completed", 2, 0), ("ingest", "status", "late", 0, 9))
    run()
    status(spark, f"{tmp_shared}/log/c", ("clean", "status", "processing", 3, 0), ("viz", "status", "up", 3, 0))
    run()
    want = {(r.service, r.field): r.value for r in ST.status_latest(spark.read.parquet(f"{tmp_shared}/log/*")).collect()}
    assert now() == want and want["ingest", "status"] == "completed"
    last = max(os.listdir(f"{ck}/commits"), key=lambda f: int(f) if f.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        os.remove(f"{ck}/commits/{name}")                                                # the last epoch is replayed
    runs = C.committed_runs(spark, root).count()
    run()
    assert now() == want and C.committed_runs(spark, root).count() == runs


def test_dedup_store_drops_copies_beyond_the_watermark_with_flat_state(spark, tmp_shared):
    t0, n = dt.datetime(2024, 1, 1), 6
    dst, seen, ck, sizes = f"{tmp_shared}/dst", f"{tmp_shared}/seen", f"{tmp_shared}/ck", []
    for k in range(n):   # each file: 20 new keys, and the first file's keys again, days behind the watermark
        rows = [(k * 100 + i, t0 + dt.timedelta(days=k, minutes=i)) for i in range(20)]
        rows += [(i, t0 + dt.timedelta(days=k, minutes=30)) for i in range(20)] if k else []
        spark.createDataFrame(rows, "id long, ts timestamp").coalesce(1).write.parquet(f"{tmp_shared}/src/{k}")
        s = spark.readStream.schema("id long, ts timestamp").parquet(f"{tmp_shared}/src/*")
        q = ST.stream_dedup_store(s, ["id"], "ts", dst, seen, ck, "1 hour", buckets=4)
        q.awaitTermination()
        sizes.append(max((o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]), default=0))
    got = [r.id for r in spark.read.parquet(dst).collect()]
    assert sorted(got) == sorted(k * 100 + i for k in range(n) for i in range(20))
    assert max(sizes[2:]) <= 2 * 40 + 20                                             # two files' keys at most, not all


def test_staged_tables_of_a_thread_stay_its_own(spark, tmp_shared):
    import threading
    made = {}

    def stream_body():
        made["df"] = materialize(spark.range(3), "other-thread")
    with staging(spark):
        t = threading.Thread(target=stream_body)
        t.start()
        t.join()
    assert made["df"].count() == 3           # the block's end has not taken the other thread's table
