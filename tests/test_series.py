"""Series index and blocks: contiguous positions, skew spread, halos."""

from pyspark.sql import functions as F

from marketframe.operators import series
from marketframe.operators.series import BLK, IDX, OWN, fill_indexed, fill_series, series_index, with_blocks
from tests.test_plans import physical


def test_index_is_contiguous_with_a_hot_key(spark):
    hot = spark.range(0, 5000).select(F.lit("HOT").alias("symbol"), F.col("id").alias("t"))
    cold = spark.range(0, 50).select(F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("symbol"),
                                     F.col("id").alias("t"))
    df = hot.unionByName(cold)
    idx = series_index(df, "symbol", "t", num_partitions=8, with_len=True)
    agg = idx.groupBy("symbol").agg(F.min(IDX).alias("lo"), F.max(IDX).alias("hi"),
                                    F.count("*").alias("n"), F.countDistinct(IDX).alias("d"),
                                    F.max("_mf_len").alias("len")).collect()
    for r in agg:
        assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n == r.len
    # position follows the order key
    bad = idx.where(F.col("symbol") == "HOT").where(F.col(IDX) != F.col("t")).count()
    assert bad == 0


def test_hot_key_is_spread_over_partitions(spark):
    df = spark.range(0, 4000).select(F.lit("HOT").alias("symbol"), F.col("id").alias("t"))
    idx = series_index(df, "symbol", "t", num_partitions=8)
    # the range layout itself splits the single key over several partitions
    ranged = df.repartitionByRange(8, "symbol", "t")
    assert ranged.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert idx.count() == 4000


def test_halo_rows(spark):
    df = spark.range(0, 10).select(F.lit("A").alias("symbol"), F.col("id").alias("t"))
    b = with_blocks(series_index(df, "symbol", "t"), block=4, halo=2).collect()
    own = sorted((r[IDX], r[BLK]) for r in b if r[OWN])
    halo = sorted((r[IDX], r[BLK]) for r in b if not r[OWN])
    assert own == [(i, i // 4) for i in range(10)]
    assert halo == [(2, 1), (3, 1), (6, 2), (7, 2)]


def test_identical_rows_spread_and_index(spark, tmp_shared):
    """A third of the rows are one repeated row: still split over partitions."""
    copies = spark.range(0, 3000).select(F.lit("A").alias("symbol"), F.lit(5).alias("t"))
    rest = spark.range(0, 6000).select(F.lit("A").alias("symbol"), (F.col("id") + 10).alias("t"))
    df = copies.unionByName(rest)
    # the index's salt: position after a local sort of each input partition
    salted = df.sortWithinPartitions(F.xxhash64("symbol", "t")).withColumn("s", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(8, "symbol", "t", "s")
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000                          # the copies did not land in one partition
    idx = series_index(df, "symbol", "t")
    r = idx.agg(F.min(IDX).alias("lo"), F.max(IDX).alias("hi"), F.countDistinct(IDX).alias("d")).first()
    assert (r.lo, r.hi, r.d) == (0, 8999, 9000)
    assert idx.where((F.col("t") == 5) & (F.col(IDX) >= 3000)).count() == 0   # copies hold positions 0..2999


def test_explicit_tiebreak(spark):
    df = spark.range(0, 100).select(F.lit("A").alias("symbol"), F.col("id").alias("t"),
                                    F.repeat(F.lit("x"), 1000).alias("blob"))
    idx = series_index(df, "symbol", "t", tiebreak=[])
    assert idx.where(F.col(IDX) != F.col("t")).count() == 0


def test_fills_take_no_frame_to_the_end(spark):
    """A frame that ends with the partition costs a row the rest of its block; backward fills run in
    reverse order instead and give the same values within blocks, super-blocks and across them."""
    rows = [("A", i, float(i) if i in (3, 17, 18, 40) else None) for i in range(50)] + [(None, i, None if i < 6 else 1.5) for i in range(9)]
    t = with_blocks(series_index(spark.createDataFrame(rows, "symbol string, t int, v double"), "symbol", "t"), 4, 0)
    filled = fill_indexed(t, ["v"], ["symbol"], fanout=2)
    assert "unboundedfollowing" not in physical(filled).lower()
    want = {}
    for key in ("A", None):
        own = [v for k, _, v in rows if k == key]
        for i in range(len(own)):
            past, later = [v for v in own[:i + 1] if v is not None], [v for v in own[i:] if v is not None]
            want[key, i] = past[-1] if past else later[0]
    assert {(r.symbol, r.t): r.v for r in filled.collect()} == want


def test_long_series_are_cut_and_the_others_filled_whole(spark, monkeypatch):
    """Series up to ``whole`` rows are sorted by one task, without a position for every row; with a lower
    limit they go through blocks, and all ways give the same rows, ties and null keys included."""
    rows = [(s, i // 3, float(i % 5) if i % 4 == 0 and i > 7 else None, i) for s, n in (("A", 90), ("B", 12), (None, 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, t int, v double, x int")
    got = lambda t: sorted(map(str, t.collect()))
    monkeypatch.setattr(series, "series_index", lambda *a, **k: 1 / 0)
    whole = got(fill_series(df, ["v"], ["symbol"], ["t"]))
    monkeypatch.undo()
    for limit in (0, 20, 50):
        assert got(fill_series(df, ["v"], ["symbol"], ["t"], block=4, whole=limit)) == whole
    last: dict = {}
    want = []
    for s, t, v, x in sorted(rows, key=lambda r: (str(r[0]), r[1], -1.0 if r[2] is None else r[2], r[3])):
        last[s] = v if v is not None else last.get(s)
        want.append([s, t, last[s], x])
    first = {s: next(v for k, _, v, _ in want if k == s and v is not None) for s in last}
    assert sorted(str((s, t, v if v is not None else first[s], x)) for s, t, v, x in want) == sorted(
        str((r.symbol, r.t, r.v, r.x)) for r in fill_series(df, ["v"], ["symbol"], ["t"]).collect())
