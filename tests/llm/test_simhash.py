import random

import numpy as np
import xxhash

from marketframe.llm import components, simhash
from tests.llm.edge import ROWS, edge_docs, empty_docs


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):  # {id: fp}
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_matches_brute_force_and_spark(spark):
    texts = [r[1] for r in ROWS] + ["One two", "one", "A b C d e", "é ß Ä É"]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fp(t) for t in texts]
    h = spark.sql("SELECT xxhash64('a b c') AS h").first().h  # the hash Spark has by that name
    assert simhash.fingerprint("a b c") == h % (1 << 64)


def test_near_duplicates_edges(spark):
    out = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[1] == by[2] == {1} and by[3] == by[4] == by[8] == {3} and 3 in by[None]
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    kept = simhash.drop_near(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 5, 7]


def test_links_in_dense_and_split_buckets(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    fps = {center}
    while len(fps) < 400:  # a dense ball, chains and noise
        x = rng.choice(sorted(fps)) if rng.random() < 0.3 else center
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 7, 15}
    ids = dict(enumerate(sorted(fps)))
    want = brute_components(ids)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in ids.values()], "fp long")
    for limit in (simhash.LIMIT, 20):  # 20: buckets are split again and again
        links = simhash.link_fingerprints(nodes, limit=limit)
        pairs = links.collect()
        assert all(bin((r.u ^ r.v) & (2 ** 64 - 1)).count("1") <= 3 for r in pairs)
        comp = {r.node: r.root for r in components.components(links).collect()}
        got = {i: comp.get(signed(x), signed(x)) for i, x in ids.items()}
        same = {}
        for i in ids:
            assert same.setdefault(want[i], got[i]) == got[i]
        assert len(set(same.values())) == len(same)


def test_components_of_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 199)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 199: 199, 200: 199}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = brute_components({r.doc_id: brute_fp(r.text) for r in rows})
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: np.int64(r.fp).view(np.uint64) for r in got} == {r.doc_id: brute_fp(r.text) for r in rows}


def test_drop_near_decides_by_row(spark):
    a, b, c, d, e, f = (" ".join(f"{x}{i * i}" for i in range(40)) for x in "abcdef")  # upper case has the same fingerprint
    rows = [(5, a), (7, a.upper()), (5, b), (2, b.upper()), (None, c), (None, c.upper()), (9, d), (9, e), (9, d),
            (11, f), (11, f.upper())]
    kept = [tuple(r) for r in simhash.drop_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(r for r in kept if r[0] in (2, 5, 7, 9)) == [(2, b.upper()), (5, a), (9, d), (9, e)]
    assert [r[1].lower() for r in kept if r[0] is None] == [c] and [r[1].lower() for r in kept if r[0] == 11] == [f]
    assert len(kept) == 6
