"""Indicators from a state, and prices carried across batches, against whole runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketframe.operators import incremental as INC
from marketframe.operators.carry import carry_prices
from marketframe.operators.indicators import INDICATOR_COLUMNS, indicators

START = dt.date(2020, 1, 1)


def series(spark, sizes, gaps=0.0, seed=3):
    rng = random.Random(seed)
    rows = []
    for s, n in sizes.items():
        x = 100.0
        for i in range(n):
            x *= 1 + rng.uniform(-0.03, 0.03)
            rows.append((s, START + dt.timedelta(days=i), None if rng.random() < gaps else x, i))
    return spark.createDataFrame(rows, "symbol string, date date, close double, extra int")


def close(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1.0, abs(a)))


def compare(spark, df, cuts, block=2048):
    whole = {(r.symbol, r.date): r for r in indicators(df).collect()}
    state, seen = None, 0
    for a, b in zip([0, *cuts], [*cuts, 10_000]):
        part = df.where((F.col("date") >= START + dt.timedelta(days=a)) & (F.col("date") < START + dt.timedelta(days=b)))
        out, state = INC.indicators_incremental(part, state, block=block)
        assert out.columns == [*df.columns, *INDICATOR_COLUMNS]
        for r in out.collect():
            want = whole[r.symbol, r.date]
            bad = [c for c in INDICATOR_COLUMNS if not close(want[c], r[c])]
            assert not bad, (r.symbol, r.date, [(c, want[c], r[c]) for c in bad])
            seen += 1
    assert seen == len(whole)
    return state


@pytest.mark.parametrize("gaps,cuts", [(0.0, [1, 5, 60]), (0.3, [3, 20, 21, 90])])
def test_batches_equal_the_whole_series(spark, gaps, cuts):
    df = series(spark, {"A": 150, "B": 4, "C": 30, "D": 61}, gaps)
    state = compare(spark, df, cuts)
    per = {r.symbol: r["n"] for r in state.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert per == {"A": 20, "B": 4, "C": 20, "D": 20}


def test_small_blocks_and_long_null_runs(spark):
    df = series(spark, {"A": 2200})
    df = df.withColumn("close", F.when((F.col("extra") < 300) | (F.col("extra") >= 1500), F.col("close")))
    compare(spark, df, [400, 1400, 1700], block=1)


def test_plan_reads_new_rows_and_the_state(spark, tmp_shared):
    df = series(spark, {"A": 100, "B": 100})
    df.withColumn("part", (F.col("extra") >= 50).cast("int")).write.partitionBy("part").parquet(f"{tmp_shared}/bars")
    bars = spark.read.parquet(f"{tmp_shared}/bars")
    _, state = INC.indicators_incremental(bars.where("part = 0"))
    state.write.parquet(f"{tmp_shared}/state")
    state = spark.read.parquet(f"{tmp_shared}/state")
    assert state.count() == 40
    new = bars.where("part = 1")
    assert all("part=1" in f for f in new._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in f) \
        or "(part#" in new._jdf.queryExecution().executedPlan().toString()
    out, _ = INC.indicators_incremental(new, state)
    assert out.count() == 100


def test_late_rows_are_put_aside(spark):
    df = series(spark, {"A": 10})
    _, state = INC.indicators_incremental(df.where("extra < 5"))
    ok, late = INC.split_late(df.where("extra >= 3"), state)
    assert sorted(r.extra for r in ok.collect()) == [5, 6, 7, 8, 9] and sorted(r.extra for r in late.collect()) == [3, 4]


def quotes(spark):
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("A", t(1, 9), 10.0, "20240101_000000"), ("A", t(1, 10), None, "20240101_000000"),
            ("A", t(2, 9), None, "20240102_000000"), ("A", t(2, 10), 12.0, "20240102_000000"),
            ("A", t(3, 9), None, "20240103_000000"), ("A", t(4, 9), None, "20240104_000000"),
            ("B", t(1, 9), None, "20240101_000000"), ("B", t(2, 9), 5.0, "20240102_000000"),
            ("B", t(3, 9), None, "20240103_000000"), (None, t(3, 9), None, "20240103_000000")]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, current_price double, batch_id string")


WANT = {("A", 1, 9): 10.0, ("A", 1, 10): 10.0, ("A", 2, 9): 10.0, ("A", 2, 10): 12.0, ("A", 3, 9): 12.0, ("A", 4, 9): 12.0,
        ("B", 1, 9): None, ("B", 2, 9): 5.0, ("B", 3, 9): 5.0, (None, 3, 9): None}


def prices(df):
    return {(r.symbol, r.timestamp.day, r.timestamp.hour): r.current_price for r in df.collect()}


def test_prices_come_from_earlier_batches_only(spark):
    out, known = carry_prices(quotes(spark))
    assert prices(out) == WANT                               # B's first batch takes nothing from its later one
    assert known.count() == 8


@pytest.mark.parametrize("cut", ["20240102_000000", "20240103_000000", "20240104_000000"])
def test_result_does_not_depend_on_what_runs_together(spark, cut):
    q = quotes(spark)
    first, known = carry_prices(q.where(F.col("batch_id") < cut))
    second, _ = carry_prices(q.where(F.col("batch_id") >= cut), known)
    assert prices(first) | prices(second) == WANT


def test_a_batch_that_runs_again_stands_for_itself(spark):
    q = quotes(spark)
    _, known = carry_prices(q)
    fixed = q.where("batch_id = '20240102_000000'").withColumn("current_price", F.lit(None).cast("double"))
    out, mine = carry_prices(fixed, known)
    assert prices(out)["A", 2, 10] == 10.0 and prices(out)["B", 2, 9] is None
