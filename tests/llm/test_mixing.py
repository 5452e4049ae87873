import random

import duckdb

from marketframe.llm import mixing, oracles, queries
from tests.llm.edge import ROWS, edge_docs, empty_docs


def test_period_is_pfair(spark):
    rng = random.Random(6)
    for k in (1, 2, 7):
        rows = [(i, float(rng.randint(1, 100))) for i in range(k)]
        shares = mixing.slot_shares(spark.createDataFrame(rows, "source int, weight double"), 97)
        table = mixing.period_table(shares).collect()
        period = table[0].period
        owner = {s: r.source for r in table for s in r.cycle}
        assert sorted(owner) == list(range(period)) and sum(r.w for r in table) == period
        for r in table:  # less than one block of deviation after every slot
            had = 0
            for t in range(2 * period):
                had += owner[t % period] == r.source
                assert abs(had - (t + 1) * r.w / period) < 1


def test_mix_edges(spark):
    out = mixing.mix(edge_docs(spark), block=20).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ROWS)
    assert {r.source for r in out} == {"a", "b", None}
    assert all(r.size == len(t or "") + 1 for r in out for t in [x[1] for x in ROWS if x[0] == r.doc_id][:1] if r.doc_id)
    lanes = {}
    for r in sorted(out, key=lambda r: (r.slot, r.at)):  # a slot belongs to one lane, blocks come in order
        assert lanes.setdefault(r.slot, r.lane) == r.lane
    mixed = mixing.mixed(edge_docs(spark), block=20)
    assert mixed.columns == edge_docs(spark).columns and mixed.count() == len(ROWS)
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.mixed(empty_docs(spark)).count() == 0


def test_given_weights_hold_on_every_prefix(spark):
    rows = [(i, "x" * 99, "a" if i % 3 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    out = sorted(mixing.mix(docs, weights, block=1000).collect(), key=lambda r: (r.slot, r.at))
    assert len({r.doc_id for r in out}) == 3000
    had = {"a": 0, "b": 0}
    for i, r in enumerate(out):  # while both last: 10 documents a block
        had[r.source] += 1
        if i < 2400:
            assert abs(had["a"] - 0.75 * (i + 1)) < 20


def test_many_sources_share_a_lane(spark):
    rows = [(i, "x" * (1 + i % 50), f"s{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, block=30, slots=20, max_sources=5).collect()
    assert len({r.doc_id for r in out}) == 400 and {r.lane for r in out} == {0, 1, 2, 3, 4, 5}


def test_files_hold_the_mixed_order(spark, tmp_shared):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixing.mixed(docs, block=5000).write.parquet(f"{tmp_shared}/m")
    import corpus_pipeline
    back = spark.read.parquet(f"{tmp_shared}/m")
    order = corpus_pipeline.stored_order(back)
    got = [r.doc_id for r in back.orderBy(*order).select("doc_id").collect()]
    want = [r.doc_id for r in sorted(mixing.mix(docs, block=5000).collect(), key=lambda r: (r.slot, r.at, r.doc_id))]
    assert got == want


def test_more_than_256_sources_match_the_oracle(spark, tmp_shared):
    rows = [(i, "x" * (1 + i * i % 977), f"s{i % 300}" if i % 300 else None) for i in range(1500)]
    rows += [(5000 + i, "y" * 150_000, f"s{i % 3}") for i in range(12)]  # more than one block
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_shared}/documents.parquet")
    got = queries.op3_source_mixing(spark, tmp_shared)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_shared}/documents.parquet/*.parquet')")
    want = con.sql(oracles.MIX)
    assert got.columns == want.columns
    got, want = sorted(map(tuple, got.collect())), sorted(want.fetchall())
    assert len(got) == len(rows) and len({r[3] for r in got}) == 301 and got == want


def test_shares_hold_against_target_weights(spark):
    weights = {"a": 0.0001, "b": 0.43217, "c": 0.31133, "d": 0.2001, "e": 0.0563}
    n = {"a": 5, "b": 1400, "c": 1100, "d": 700, "e": 250}  # one block each document
    rows = [(f"{s}{i}", "x" * 9, s) for s in n for i in range(n[s])]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    out = mixing.mix(docs, spark.createDataFrame(list(weights.items()), "source string, weight double"), block=10).collect()
    assert sorted(r.slot for r in out) == list(range(len(rows)))
    total, had = sum(weights.values()), dict.fromkeys(n, 0)
    for t, r in enumerate(sorted(out, key=lambda r: r.slot), 1):
        assert r.block == had[r.source]
        had[r.source] += 1
        assert all(abs(had[s] - t * weights[s] / total) < 1 for s in n)
        if had[r.source] == n[r.source]:
            break
    assert t > 3000
