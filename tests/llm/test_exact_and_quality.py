import hashlib
import random
import re
from collections import Counter

from marketframe.llm import exact_dedup, quality
from tests.llm.edge import EXTRA, ROWS, edge_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_groups_edges(spark):
    got = exact_dedup.exact_groups(edge_docs(spark)).collect()
    assert len(got) == len(ROWS)
    texts = Counter(r[1] or "" for r in ROWS)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in texts}
    for r in got:
        ids = [x[0] for x in ROWS if (x[1] or "") == sha[r.text_sha256] and x[0] is not None]
        assert r.group_size == texts[sha[r.text_sha256]] and r.keep_id == max(ids, default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(texts)
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0


def test_drop_exact_keeps_columns_and_one_row(spark):
    docs = edge_docs(spark)
    for support in (0.001, 0.25):  # with and without heavy digests
        out = exact_dedup.drop_exact(docs, support=support)
        assert out.columns == docs.columns
        rows = out.collect()
        assert sorted((r.text or "") for r in rows) == sorted({r[1] or "" for r in ROWS})
        assert {r.doc_id for r in rows} == {2, 4, 5, 7, 8, None} and all(tuple(r[4:]) == EXTRA for r in rows)
    assert exact_dedup.drop_exact(empty_docs(spark)).count() == 0


def test_heavy_digests_are_verified_and_bounded(spark):
    rows = [("hot",)] * 400 + [(f"t{i % 300}",) for i in range(600)]
    df = spark.createDataFrame(rows, "digest string").repartition(7)
    assert [r.digest for r in exact_dedup.heavy_digests(df, "digest", 0.1).collect()] == ["hot"]


def brute_stats(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    marked = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines),
            len(lines) - len(set(lines)), len(marked), sum(a == b for a, b in zip(words, words[1:])))


def test_stats_against_brute_force(spark):
    rng = random.Random(5)
    texts = [r[1] for r in ROWS] + ["a b c d e a b c d e", "a a a a a a", "a a a a a", "x\nx\ny\n \nx", "#*$ %&|<> é b"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", " ", "\n", "\t", "#", "ß"]) for _ in range(rng.randint(0, 120))))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", quality.text_stats("text").alias("s"))
    for r in df.collect():
        assert tuple(r.s) == brute_stats(texts[r.i]), texts[r.i]


def test_quality_edges_and_columns(spark):
    docs = edge_docs(spark)
    q = quality.quality(docs).collect()
    assert len(q) == len(ROWS) and {r.row.doc_id for r in q if r.kept} <= {1, 2, 5}
    assert all(r.base_failed == (r.stats.n_words < 10 or 100 * r.stats.n_repeat_words > 20 * r.stats.n_words) for r in q)
    out = quality.drop_low_quality(docs)
    assert out.columns == docs.columns and out.count() == sum(r.kept for r in q)
    assert quality.quality(empty_docs(spark)).count() == 0


def test_thresholds_reject_outliers_and_keep_clean(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(60)]
        junk = i % 10 == 0
        rows.append((i, " ".join(w + "###" if junk else w for w in words), "en", f"s{i % 2}" if i < 290 else f"tiny{i}"))
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.row.doc_id for r in got if not r.kept} == {i for i in range(300) if i % 10 == 0}


def test_sketch_merges_exactly(spark):
    rows = [(i, " ".join(["w" * (1 + i % 7)] * (10 + i % 40)), "en", f"s{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    parts = quality._stats_rows(docs, [], "text", "lang", "source")
    merged = quality.merge_sketches(quality.sketches(parts), "lang").orderBy("ratio", "bucket").collect()
    from pyspark.sql import functions as F
    whole = quality.sketches(parts.withColumn("source", F.lit("x"))).drop("source").orderBy("ratio", "bucket").collect()
    assert [tuple(r) for r in merged] == [tuple(r) for r in whole]


def test_each_fence_rejects_its_junk_and_clean_documents_stay(spark):
    clean = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1 AND toxic = 0"), "doc_id").collect()]
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    junk = {
        -1: " ".join(f"{word(5)} | #" for _ in range(30)),                       # symbols
        -2: " ".join(f"{w} {w}" for w in (word(5) for _ in range(30))),          # words that stutter
        -3: "\n".join(x for _ in range(8) for x in [f"{word(3)} {word(6)}"] * 2) + "\n" + " ".join(word(5) for _ in range(90)),
        -4: " ".join(word(40) for _ in range(12)),                               # words too long
        -5: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)),  # words too short
    }
    rows = clean + [(i, t, "en", "src1") for i, t in junk.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.row.doc_id: (r.base_failed, r.kept) for r in quality.quality(df).collect()}
    for i in junk:
        assert got[i] == (False, False), (i, got[i])
    assert all(kept or failed for i, (failed, kept) in got.items() if i >= 0)
