import random
import re
from collections import Counter, defaultdict

from marketframe.llm import divergence as D
from tests.llm.edge import ROWS, edge_docs, empty_docs

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=200):
    """rows: (text, lang, source) -> {(lang, source, part): [(value, item), ..] in rank order}."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups.add((lang, source))
    out = {}
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        sources = sorted(s for x, s in groups if x == lang)

        def probs(n):
            size = sum(n[t] for t in kept)
            return {t: 1 + 10 ** 9 * (n[t] + 1) // (size + len(kept)) for t in kept}
        p = {s: probs(count[lang, s]) for s in sources}
        q = probs(sum((count[lang, s] for s in sources), Counter()))
        gap = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pair = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(gap(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, got, n in (("pair", pair, None), ("term", term, top)):
                out[lang, s, part] = sorted(got, key=lambda x: (-x[0], x[1].encode()))[:n]
    return {k: v for k, v in out.items() if v}


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out[r.lang, r.source, r.part].append((r.value, r["item"]))
        assert len(out[r.lang, r.source, r.part]) == r["rank"]
    return dict(out)


def test_audit_matches_brute_force_whatever_the_block(spark):
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[i % 10]}{'xyzé'[i // 10]}" for i in range(40)]
    rows = [(" ".join(rng.choices(words, [1 / (i + 1) for i in range(40)], k=rng.randint(0, 30))).title(),
             rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None, f"own{i % 3}"])) for i in range(300)]
    rows += [("", "en", "silent"), (None, "xx", "only"), ("1 2 3", "xx", "digits")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    want = brute(rows, 7)
    for block in (10, 1 << 19):
        assert found(D.audit(df, top=7, block=block)) == want


def test_sums_are_exact_beyond_64_bits_of_product(spark):
    from pyspark.sql import functions as F
    n, size, kept = 16_000_000_000_000, 17_000_000_000_000, 12_345
    got = spark.range(1).select(D._prob(F.lit(n).cast("bigint"), F.lit(size).cast("bigint"), F.lit(kept).cast("bigint")).alias("p"))
    assert got.first().p == 1 + 10 ** 9 * (n + 1) // (size + kept)


def test_long_texts_are_split_between_terms():
    text = b"alpha beta " * 1_000_000
    assert b"".join(D._pieces(text)) == text
    assert sum(len(D._TERM.findall(p)) for p in D._pieces(text)) == 2_000_000


def test_edges(spark):
    assert found(D.audit(edge_docs(spark))) == brute([(r[1], r[2], r[3]) for r in ROWS])
    assert D.audit(empty_docs(spark)).count() == 0
