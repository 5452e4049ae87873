"""Every stage against a brute-force version of it, on the output of the stage before."""

import hashlib

import corpus_pipeline
from tests.llm.edge import edge_docs, empty_docs
from tests.llm.test_packing_and_files import check_packed
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_shared):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts, kept = docs.columns, {}, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_shared}/{k}")
        docs = spark.read.parquet(f"{tmp_shared}/{k}")
        rows = docs.collect()
        kept = {r.doc_id for r in rows}
        if name != "best_fit_packing":
            assert docs.columns == columns and len(kept) == len(rows)
        if name == "quality_rules":
            from marketframe.llm import quality
            q = quality.quality(spark.read.parquet(f"{SF}/documents.parquet")).collect()
            assert kept == {r.row.doc_id for r in q if r.kept}
        elif name == "exact_dedup":
            best = {}
            for d, t in before.items():
                key = hashlib.sha256(t.encode()).hexdigest()
                best[key] = max(best.get(key, -1), d)
            assert kept == set(best.values())
        elif name == "simhash_near_dedup":
            assert kept == set(brute_components({d: brute_fp(t) for d, t in before.items()}).values())
        elif name == "source_mixing":
            assert kept == set(before)
            texts = {d: [t] for d, t in before.items()}
        else:
            check_packed(rows, texts, 1024)
            assert kept == set(texts)


def test_stages_take_edge_rows_and_empty_tables(spark, tmp_shared):
    for make, at in ((edge_docs, "e"), (empty_docs, "n")):
        docs = make(spark)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs.write.parquet(f"{tmp_shared}/{at}{k}")
            docs = stage(spark, spark.read.parquet(f"{tmp_shared}/{at}{k}"), SF)
        docs.count()


def test_run_is_the_chain_of_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
