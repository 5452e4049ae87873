"""End-to-end ingest and cleaning runs over shared storage, with reruns."""

import os

from pyspark.sql import functions as F

from marketframe.plans import jobs as J
from marketframe.sources import bindings as B

SF = "/root/testdata/sf0.001"


def land_csv(df, path, prefix):
    """One headered CSV per batch, named like the reference's files (test helper)."""
    for r in df.select("batch_id").distinct().collect():
        pdf = df.where(F.col("batch_id") == r.batch_id).drop("batch_id").toPandas()
        pdf.to_csv(f"{path}/{prefix}{r.batch_id}.csv", index=False)


def test_run_ingest(spark, tmp_shared):
    land = B.landing_all(spark, SF)
    summ = {r.batch_id: r for r in J.run_ingest(spark, land, tmp_shared).collect()}
    fetch = summ[B.FETCH_BATCH]
    assert fetch.data_summary["historical"] == 150 and fetch.files_created >= 10
    assert spark.read.parquet(f"{tmp_shared}/quotes").count() == 150
    assert spark.read.parquet(f"{tmp_shared}/status_log").where("field = 'files_created'").count() == len(summ)


def test_run_cleaning_and_rerun(spark, tmp_shared):
    raw = f"{tmp_shared}/raw"
    os.makedirs(raw)
    q = B.quotes_events(spark, SF).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    land_csv(q.where("batch_id <= '20240103_000000'"), raw, "stock_quotes_")
    land_csv(B.bars_gaps(spark, SF).withColumn("date", F.col("date").cast("string")), raw, "stock_historical_")
    with open(f"{raw}/stock_quotes_20240104_000000.csv", "w") as f:
        f.write("symbol,current_price\nclick,oops\n")                      # one malformed batch
    root = f"{tmp_shared}/out"
    s1 = J.run_cleaning(spark, raw, root).first()
    assert s1.total_files_processed == 4                                   # 3 quote batches + 1 bars batch
    assert spark.read.parquet(f"{root}/processed_quotes").count() == 15
    assert spark.read.parquet(f"{root}/processed_bars").count() == 150
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    assert J.run_cleaning(spark, raw, root) is None                         # rerun: nothing pending
    land_csv(q.where("batch_id = '20240105_000000'"), raw, "stock_quotes_")
    s3 = J.run_cleaning(spark, raw, root).first()
    assert s3.total_files_processed == 1
    assert spark.read.parquet(f"{root}/processed_quotes").count() == 20
    status = spark.read.parquet(f"{root}/status_log").where("field = 'status'").orderBy("ts").collect()
    assert [r.value for r in status] == ["processing", "completed", "processing", "idle", "processing", "completed"]
    assert spark.read.json(f"{root}/run_summaries").count() == 2
    assert spark.read.parquet(f"{root}/quarantine").count() == 1            # not repeated by reruns
    assert spark.read.parquet(f"{root}/run_files").count() == 5
    files = spark.read.parquet(f"{root}/status_log").where("field = 'processed_files'").collect()
    assert '["stock_quotes_20240105_000000.csv"]' in {r.value for r in files}


def test_failed_cleaning_reports_an_error(spark, tmp_shared, monkeypatch):
    os.makedirs(f"{tmp_shared}/raw")
    with open(f"{tmp_shared}/raw/stock_quotes_20240104_000000.csv", "w") as f:
        f.write("symbol,current_price\nclick,oops\n")                      # nothing usable
    root = f"{tmp_shared}/out"
    assert J.run_cleaning(spark, f"{tmp_shared}/raw", root) is None
    status = lambda: [r.value for r in spark.read.parquet(f"{root}/status_log")
                      .where("field = 'status'").orderBy("ts").collect()]
    assert status() == ["processing", "error"]
    assert J.run_cleaning(spark, f"{tmp_shared}/raw", root) is None          # handled: not read again
    assert status()[-1] == "idle"
    monkeypatch.setattr(J, "pending_files", lambda *a: 1 / 0)
    try:
        J.run_cleaning(spark, f"{tmp_shared}/raw", root)
    except ZeroDivisionError:
        pass
    assert status()[-1] == "error"


def test_two_ingest_runs_keep_both_landings(spark, tmp_shared):
    land = B.landing_quote(spark, SF)
    for day in ("20240105_000000", "20240106_000000"):
        out = J.run_ingest(spark, land.where(F.col("batch_id") == day), tmp_shared).collect()
        assert [r.batch_id for r in out] == [day]
    both = land.where(F.col("batch_id").isin("20240105_000000", "20240106_000000"))
    assert spark.read.parquet(f"{tmp_shared}/landing").count() == both.count()
    assert spark.read.parquet(f"{tmp_shared}/quotes").count() == 10
    assert spark.read.parquet(f"{tmp_shared}/events").count() == 2
    done = spark.read.parquet(f"{tmp_shared}/status_log").where("field = 'files_created'")
    assert done.count() == 2
