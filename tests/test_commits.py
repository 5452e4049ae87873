"""Runs of a store: all or nothing, whatever dies where; retention and vacuum."""

import os

import pytest
from pyspark.sql import functions as F

from marketframe.plans import jobs as J
from marketframe.sources import bindings as B
from marketframe.sources import commits as C

SF = "/root/testdata/sf0.001"


class Killed(Exception):
    pass


def rows(spark, batch, *values):
    return spark.createDataFrame([(v, batch) for v in values], "v long, batch_id string")


def put(spark, root, run, df, by=("batch_id",), table="t"):
    C.stage_rows(df, root, table, run, by)
    return C.commit(spark, root, run, "test", {table: list(by)})


def got(spark, root, table="t"):
    df = C.read(spark, root, table)
    return [] if df is None else sorted(map(tuple, df.collect()))


def test_readers_see_committed_runs_only(spark, tmp_shared):
    assert got(spark, tmp_shared) == []
    assert put(spark, tmp_shared, "r1", rows(spark, "20240101_000000", 1, 2))
    C.stage_rows(rows(spark, "20240102_000000", 3), tmp_shared, "t", "r2")       # dies before its commit
    assert got(spark, tmp_shared) == [(1, "20240101_000000"), (2, "20240101_000000")]
    assert put(spark, tmp_shared, "r3", rows(spark, "20240101_000000", 9))       # replaces the batch
    assert not put(spark, tmp_shared, "r3", rows(spark, "20240101_000000", 9))   # the same run again: nothing
    assert got(spark, tmp_shared) == [(9, "20240101_000000")]
    assert [r.run_id for r in C.committed_runs(spark, tmp_shared).orderBy("seq").collect()] == ["r1", "r3"]


def test_a_run_adds_to_unpartitioned_tables_once(spark, tmp_shared):
    for run in ("r1", "r2", "r2"):
        put(spark, tmp_shared, run, spark.createDataFrame([(run,)], "m string"), (), "events")
    assert got(spark, tmp_shared, "events") == [("r1",), ("r2",)]


def test_expired_partitions_go_and_readers_in_flight_stay(spark, tmp_shared):
    for k, day in enumerate(("20240101_000000", "20240102_000000", "20240110_000000")):
        put(spark, tmp_shared, f"r{k}", rows(spark, day, k))
    put(spark, tmp_shared, "r9", rows(spark, "20240110_000000", 5))               # r2's partition is replaced
    reader = C.read(spark, tmp_shared, "t")
    C.expire(spark, tmp_shared, "t", 5, "2024-01-10 00:00:00")
    assert got(spark, tmp_shared) == [(5, "20240110_000000")]
    C.stage_rows(rows(spark, "20240111_000000", 7), tmp_shared, "t", "r10")       # a run still under way
    assert C.vacuum(spark, tmp_shared, "t", 3600) == 0                            # within the time of grace
    assert sorted(r.v for r in reader.collect()) == [0, 1, 5]
    C.commit(spark, tmp_shared, "r10", "test", {"t": ["batch_id"]})
    C.stage_rows(rows(spark, "20240112_000000", 8), tmp_shared, "t", "r11")       # never commits
    assert C.vacuum(spark, tmp_shared, "t", 0) == 4                               # two expired, one replaced, one lost run
    assert got(spark, tmp_shared) == [(5, "20240110_000000"), (7, "20240111_000000")]
    left = [d for d, _, names in os.walk(f"{tmp_shared}/t") if any(n.endswith(".parquet") for n in names)]
    assert len(left) == 2


def test_log_compaction_keeps_every_result(spark, tmp_shared):
    for k in range(4):
        put(spark, tmp_shared, f"r{k}", rows(spark, f"2024010{k % 2 + 1}_000000", k))
    before = got(spark, tmp_shared)
    C.compact_log(spark, tmp_shared)
    assert len(C.log(spark, tmp_shared).inputFiles()) == 1 and got(spark, tmp_shared) == before
    put(spark, tmp_shared, "r7", rows(spark, "20240101_000000", 7))
    assert (7, "20240101_000000") in got(spark, tmp_shared)


def kill_at(monkeypatch, n, after=True):
    """The n-th staged write or commit of a run dies, after or before it has acted."""
    seen = {"n": 0}

    def wrap(real, counted):
        def call(*a, **kw):
            if not counted(*a, **kw):
                return real(*a, **kw)
            seen["n"] += 1
            if seen["n"] == n and not after:
                raise Killed
            out = real(*a, **kw)
            if seen["n"] == n:
                raise Killed
            return out
        return call
    # status updates at the start are runs of their own and not counted
    monkeypatch.setattr(C, "stage_rows", wrap(C.stage_rows, lambda df, root, table, run, *a, **kw: run == "rjob"))
    monkeypatch.setattr(C, "commit", wrap(C.commit, lambda spark, root, run, *a, **kw: run == "rjob"))
    return seen


def raw_folder(spark, path):
    os.makedirs(path)
    q = B.quotes_events(spark, SF).where("batch_id <= '20240102_000000'")
    for r in q.select("batch_id").distinct().collect():
        q.where(F.col("batch_id") == r.batch_id).drop("batch_id").toPandas().to_csv(
            f"{path}/stock_quotes_{r.batch_id}.csv", index=False)
    with open(f"{path}/stock_quotes_20240104_000000.csv", "w") as f:
        f.write("symbol,current_price\nclick,oops\n")


# staged: quotes, quarantine, handled, reports, files, summary, status, event; then the commit
@pytest.mark.parametrize("n,after", [(1, True), (5, True), (9, False), (9, True)])
def test_cleaning_killed_and_repeated(spark, tmp_shared, monkeypatch, n, after):
    raw, root = f"{tmp_shared}/raw folder 50%+x", f"{tmp_shared}/out"
    raw_folder(spark, raw)
    with monkeypatch.context() as m:
        kill_at(m, n, after)
        with pytest.raises(Killed):
            J.run_cleaning(spark, raw, root, "rjob")
        if n < 9 or not after:
            assert C.read(spark, root, "processed_quotes") is None and C.read(spark, root, "events") is None
    out = J.run_cleaning(spark, raw, root, "rjob")           # the scheduler tries again, with the same id
    assert out.first().total_files_processed == 2
    assert C.read(spark, root, "processed_quotes").count() == 10
    for table, n_rows in (("events", 1), ("run_files", 2), ("quarantine", 1)):
        assert C.read(spark, root, table).count() == n_rows
    assert C.read(spark, root, "run_summaries", fmt="json").count() == 1
    done = C.read(spark, root, "status_log").where("field = 'status' AND value = 'completed'")
    assert done.count() == 1
    assert J.run_cleaning(spark, raw, root) is None           # all handled


def test_ingest_killed_and_repeated_under_another_id(spark, tmp_shared, monkeypatch):
    land = B.landing_quote(spark, SF).where("batch_id = '20240105_000000'")
    with monkeypatch.context() as m:
        kill_at(m, 16, True)                                  # landing, 12 tables, summary, status, event
        with pytest.raises(Killed):
            J.run_ingest(spark, land, tmp_shared, "rjob")
    assert C.read(spark, tmp_shared, "quotes") is None
    J.run_ingest(spark, land, tmp_shared)
    assert C.read(spark, tmp_shared, "quotes").count() == 5
    assert C.read(spark, tmp_shared, "events").count() == 1


def test_a_second_feed_of_a_batch_keeps_the_first(spark, tmp_shared):
    day = "20240131_000000"
    quotes = B.landing_quote(spark, SF).where("batch_id = '20240105_000000'").withColumn("batch_id", F.lit(day))
    J.run_ingest(spark, quotes, tmp_shared)
    out = J.run_ingest(spark, B.landing_candle(spark, SF), tmp_shared).collect()
    assert [(r.batch_id, r.data_summary["quotes"], r.data_summary["historical"]) for r in out] == [(day, 5, 150)]


def test_a_run_reads_its_own_partitions_only(spark, tmp_shared):
    land = B.landing_quote(spark, SF)
    for day in ("20240105_000000", "20240106_000000"):
        J.run_ingest(spark, land.where(F.col("batch_id") == day), tmp_shared)
    own = [r.run_id for r in C.live_parts(spark, tmp_shared, "landing").where("part[0] = '20240106_000000'").collect()]
    files = C.staged_rows(spark, tmp_shared, "landing", own[0]).inputFiles()
    assert files and all("batch_id=20240106_000000" in f for f in files)
    plan = C.read(spark, tmp_shared, "quotes").where(F.col("batch_id").isin("20240106_000000"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "20240106_000000" in plan.split("PartitionFilters: [")[1].split("]")[0]
