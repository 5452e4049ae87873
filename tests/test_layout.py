"""Data skipping by symbol, sketch medians, one exchange for fills."""

import contextlib
import glob
import io
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from marketframe.operators import sketches as SK
from marketframe.operators.series import fill_indexed, series_index, with_blocks
from marketframe.sources import storage as S


def test_row_groups_read_for_one_symbol(spark, tmp_shared):
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 40).cast("string"))).alias("symbol"),
        F.expr("date_add(DATE'2020-01-01', cast(id / 40 AS int))").alias("date"), F.rand(1).alias("close"),
        F.lit("20240101_000000").alias("batch_id")).repartition(6)
    S.write_table(rows, f"{tmp_shared}/plain")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # a few MB would be one task's
    try:
        S.write_clustered(rows, f"{tmp_shared}/t", row_group_bytes=64 << 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def groups(path, symbol):
        seen = every = 0
        for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("symbol")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(at).statistics
                seen, every = seen + (s.min <= symbol <= s.max), every + 1
        return seen, every
    seen, every = groups(f"{tmp_shared}/t", "S7")
    assert every >= 20 and seen <= 4                       # one symbol of 41 lies in a few row groups
    assert groups(f"{tmp_shared}/plain", "S7")[0] == groups(f"{tmp_shared}/plain", "S7")[1]
    hot = {f for f in glob.glob(f"{tmp_shared}/t/**/*.parquet", recursive=True)
           if "HOT" in pq.read_table(f, columns=["symbol"]).column(0).to_pylist()}
    assert len(hot) >= 2                                   # the hot symbol is not one task's
    q = spark.read.parquet(f"{tmp_shared}/t").where("symbol = 'S7'")
    assert q.count() == rows.where("symbol = 'S7'").count()
    bloom = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{tmp_shared}/t/**/*.parquet", recursive=True)]
    assert bloom


def test_sketch_medians_within_their_bound_after_merging(spark):
    rng = random.Random(2)
    rows = [("a", rng.lognormvariate(0, 2), i % 5) for i in range(20_000)] + [("b", 1.0, 0), ("b", 3.0, 1), ("c", None, 0)]
    df = spark.createDataFrame(rows, "batch_id string, v double, load int")
    parts = None
    for k in range(5):
        s = SK.value_sketches(df.where(F.col("load") == k), ["v"])
        parts = s if parts is None else parts.unionByName(s)
    merged = SK.merge_sketches(parts)
    got = {r.batch_id: r.v for r in SK.sketch_medians(merged, ["v"]).collect()}
    values = sorted(v for b, v, _ in rows if b == "a")
    off = lambda x: abs(sum(v <= x for v in values) / len(values) - 0.5)
    assert off(got["a"]) <= 2 * SK.rank_error()
    assert got["b"] in (1.0, 3.0) and "c" not in got
    filled = SK.fill_from_sketches(df.where("batch_id = 'c'").withColumn("batch_id", F.lit("a")), merged, ["v"]).first()
    assert off(filled.v) <= 2 * SK.rank_error()      # merges draw at random, so not the same value each time


def test_fill_has_one_exchange_on_the_data(spark):
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("symbol"), F.expr("date_add(DATE'2020-01-01', cast(id AS int))").alias("date"),
                                  F.when(F.col("id") % 4 == 0, F.col("id").cast("double")).alias("close"))
    df = df.withColumn("symbol", F.when(F.col("symbol") != "2", F.col("symbol")))   # a null key is a series of its own
    idx = with_blocks(series_index(df, ["symbol"], ["date"]), 64, 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fill_indexed(idx, ["close"], ["symbol"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        lines = buf.getvalue().splitlines()
        top = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln and "LeftOuter" in ln)
        window = next(i for i in range(top, len(lines)) if "Window [" in lines[i])
        assert not any("Exchange" in ln for ln in lines[top:window])   # the join takes the windows' partitioning
        got = {(r.symbol, r.date): r.close for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    last, first, want = {}, {}, {}
    rows = sorted(((r.symbol or "", r.date, r.symbol, r.close) for r in df.collect()), key=lambda r: r[:2])
    for name, date, symbol, c in rows:
        last[name] = c if c is not None else last.get(name)
        want[symbol, date] = last[name]
    for name, date, symbol, c in reversed(rows):
        first[name] = c if c is not None else first.get(name)
        if want[symbol, date] is None:
            want[symbol, date] = first[name]
    assert got == want
