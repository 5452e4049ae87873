"""Scans, sinks, batch ids and pending batches."""

from pyspark.sql import functions as F

from marketframe.sources import storage as S


def test_parse_batch_full_id(spark):
    names = ["stock_quotes_20240101_101500.csv", "stock_quotes_20240102_101500.csv",
             "stock_historical_20240101_101500.csv", "junk.csv"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    out = {r.file_name: r.p for r in df.select("file_name", S.parse_batch(F.col("file_name")).alias("p")).collect()}
    # same time of day on two days -> two different ids (the reference kept only the time)
    assert out[names[0]].batch_id != out[names[1]].batch_id
    assert out[names[2]].kind == "historical" and out[names[0]].kind == "quotes"
    assert out["junk.csv"].batch_id is None and out["junk.csv"].batch_ts is None


def test_pending_batches(spark):
    raw = spark.createDataFrame([("quotes", "a"), ("quotes", "b"), ("historical", "a"), ("quotes", "a")],
                                "kind string, batch_id string")
    done = spark.createDataFrame([("quotes", "a")], "kind string, batch_id string")
    assert sorted(tuple(r) for r in S.pending_batches(raw, done).collect()) == [("historical", "a"), ("quotes", "b")]


def test_write_is_idempotent_and_pruned(spark, tmp_shared):
    df = spark.createDataFrame([("A", 1.0, "b1"), ("B", 2.0, "b1"), ("A", 3.0, "b2")],
                               "symbol string, v double, batch_id string")
    path = f"{tmp_shared}/t"
    S.write_table(df, path)
    S.write_table(df.where("batch_id = 'b2'"), path)          # rerun of one batch
    back = S.read_table(spark, path)
    assert back.count() == 3
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        back.where("batch_id = 'b2'").explain()
    assert "PartitionFilters: [isnotnull(batch_id" in buf.getvalue()
    S.write_table(df.where("false"), f"{tmp_shared}/empty")     # empty feed -> no partitions
    import os
    assert not any(n.startswith("batch_id=") for n in os.listdir(f"{tmp_shared}/empty"))


def test_csv_and_json_roundtrip(spark, tmp_shared):
    df = spark.createDataFrame([("A", 1.5, "b1")], "symbol string, v double, batch_id string")
    S.write_table(df, f"{tmp_shared}/csv", fmt="csv")
    back = S.read_table(spark, f"{tmp_shared}/csv", "symbol string, v double, batch_id string", fmt="csv")
    assert [tuple(r) for r in back.collect()] == [("A", 1.5, "b1")]
    S.write_summary(df.select(F.struct("symbol", "v").alias("doc")), f"{tmp_shared}/json")
    assert S.read_summary(spark, f"{tmp_shared}/json").first().doc.v == 1.5
    files = S.list_files(spark, f"{tmp_shared}/csv/batch_id=b1", "*.csv")
    assert files.count() >= 1
    globbed = S.read_table(spark, f"{tmp_shared}/csv/batch_id=b1", "symbol string, v double", fmt="csv",
                           glob="part-*.csv")
    assert globbed.count() == 1


def test_retain(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-25 00:00:00",)], "batch_ts string") \
              .select(F.col("batch_ts").cast("timestamp").alias("batch_ts"))
    assert S.retain(df, 7, "2024-01-30 00:00:00").count() == 1


def test_latest_batch_prunes_partitions(spark, tmp_shared):
    import contextlib
    import io

    from marketframe.operators.views import latest_batch
    df = spark.createDataFrame([("A", 1.0, "b1"), ("A", 3.0, "b2")], "symbol string, v double, batch_id string")
    S.write_table(df, f"{tmp_shared}/p")
    back = S.read_table(spark, f"{tmp_shared}/p")
    out = latest_batch(back)
    assert [r.v for r in out.collect()] == [3.0]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    scan = [ln for ln in buf.getvalue().splitlines() if "FileScan" in ln and "symbol" in ln][0]
    assert "PartitionFilters: [isnotnull(batch_id" in scan and "Subquery" in scan


def test_raw_batches_skip_bad_rows(spark, tmp_shared):
    import os
    from pyspark.sql import types as T
    d = f"{tmp_shared}/raw"
    os.makedirs(d)
    with open(f"{d}/stock_quotes_20240101_000000.csv", "w") as f:
        f.write("symbol,current_price\nA,1.5\nB,not-a-number\n")
    with open(f"{d}/stock_quotes_20240102_000000.csv", "w") as f:
        f.write("symbol,current_price\nA,2.5\n")
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("current_price", T.DoubleType())])
    good, bad = S.read_raw_batches(spark, d, schema)
    assert sorted((r.batch_id, r.symbol, r.current_price) for r in good.collect()) == [
        ("20240101_000000", "A", 1.5), ("20240102_000000", "A", 2.5)]
    assert [(r.batch_id, r.record) for r in bad.collect()] == [("20240101_000000", "B,not-a-number")]


def test_columns_are_taken_by_header_name(spark, tmp_shared):
    import os
    d = f"{tmp_shared}/named"
    os.makedirs(d)
    files = {"stock_quotes_20240101_000000.csv": "symbol,previous_close,current_price\nA,1.0,2.0\n",
             "stock_quotes_20240102_000000.csv": "current_price,symbol,extra\n3.0,B,x\n",
             "stock_quotes_20240103_000000.csv": "symbol,current_price,previous_close\nC,4.0,5.0\n"}
    for name, text in files.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    good, bad = S.read_raw_batches(spark, d, spark.createDataFrame(
        [], "symbol string, current_price double, previous_close double").schema)
    assert sorted((r.symbol, r.current_price, r.previous_close) for r in good.collect()) == [
        ("A", 2.0, 1.0), ("B", 3.0, None), ("C", 4.0, 5.0)]
    assert bad.count() == 0
