import random
import re

from marketframe.llm import decontaminate as L
from tests.llm.edge import ROWS, edge_docs, empty_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        ws = words(text)
        n = min(len(ws), window)
        for i in range(len(ws) - n + 1 if n else 0):
            wins.setdefault(tuple(ws[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for text in docs:
        ws, hit, got = words(text), set(), set()
        for n in {len(w) for w in wins}:
            for i in range(len(ws) - n + 1):
                if (w := tuple(ws[i:i + n])) in wins:
                    hit.update(range(i, i + n))
                    got |= wins[w]
        out.append((len(ws), len(hit), sorted(got)))
    return out


def check(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.row.doc_id: (r.n_words, r.n_hit, r["items"]) for r in L.contamination(d, b).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, items)


def planted(seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(30)] + ["É", "ß", "x9"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(9, 40))) for i in range(12)]
    items += [(20, "v1 v2 v3"), (21, "V1, v2; v3."), (22, "É"), (23, ""), (24, None), (None, text(15)), (0, items[0][1]),
              (25, "v5 " * 25), (26, items[1][1])]
    docs = [None, "", "...", "v5 " * 60, text(8)]
    for _ in range(60):
        _, it = rng.choice(items)
        ws = (it or "").split()
        n = rng.choice([6, 9, 10, 11, 30])
        at = rng.randint(0, max(0, len(ws) - n))
        docs.append(" ".join([text(rng.randint(0, 30)), " ".join(ws[at:at + n]).upper(), text(rng.randint(0, 30))]))
    return docs + docs[5:9] * 3, items


def test_matches_brute_force(spark):
    check(spark, *planted(1))


def test_matches_brute_force_without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, *planted(2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_winnowing_keeps_a_common_hash_of_every_shared_window(spark):
    from pyspark.sql import functions as F
    rng = random.Random(7)
    shared = [f"s{i}" for i in range(10)]
    rows = [([f"n{rng.random()}" for _ in range(rng.randint(0, 20))] + shared + [f"n{rng.random()}" for _ in range(rng.randint(0, 20))],)
            for _ in range(30)]
    df = spark.createDataFrame(rows, "ws array<string>")
    got = [{x["hash"] for x in r.f} for r in df.select(L.fingerprints(F.col("ws"), [10]).alias("f")).collect()]
    assert set.intersection(*got)
    assert sum(map(len, got)) < 0.6 * sum(len(r[0]) for r in rows)


def test_edges(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "straße 東京")],
                                  "item_id long, text string")
    got = L.contamination(edge_docs(spark), items).collect()
    want = brute([r[1] for r in ROWS], [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "straße 東京")])
    order = lambda rows: sorted(rows, key=repr)
    assert order((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == order(
        (r[0], *w) for r, w in zip(ROWS, want))
    clean = L.drop_contaminated(edge_docs(spark), items)
    assert clean.columns == edge_docs(spark).columns and clean.count() == len(ROWS) - 4
    assert L.contamination(empty_docs(spark), items).count() == 0
    assert not any(r.contaminated for r in L.contamination(edge_docs(spark), items.limit(0)).collect())
