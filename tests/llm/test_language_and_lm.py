import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketframe.llm import language, lm_score
from marketframe.llm.common import id_crc32
from tests.llm.edge import ROWS, edge_docs, empty_docs

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    out, word = Counter(), []
    for ch in [*text.lower(), " "]:
        if ch.isalpha():
            word.append(ch)
        elif word:
            s = ["", *word, ""]  # blanks around
            for k in range(1, len(s) - 1):
                out[s[k]] += 1
                out[(s[k - 1], s[k])] += 1
                out[(s[k - 1], s[k], s[k + 1])] += 1
            out[(s[-2], s[-1])] += 1
            word = []
    return out


def code(g):
    n = 0
    for ch in g:
        n = n << 21 | (ord(ch) if ch else 32)
    return n


def test_ngrams_against_brute_force(monkeypatch):
    texts = [r[1] or "" for r in ROWS] + ["a", "a b", " ab, cd", "İstanbul ÇA", "x" * 50 + " " + "yz " * 30]
    want = [{code(g): n for g, n in brute_grams(t).items()} for t in texts]
    for chunk in (1_000_000, 7):
        monkeypatch.setattr(language, "_CHUNK", chunk)
        for t, w in zip(texts, want):
            if chunk == 7 and len(t) > 5000:
                continue
            codes, counts = language.ngram_counts(t)
            assert dict(zip(codes.tolist(), counts.tolist())) == w, t


def test_distance_is_out_of_place():
    p = language.Profiles([("a", 10, 0), ("a", 11, 1), ("b", 11, 0)], 3)
    own = np.array([11, 10, 12])
    assert p.distances(own).tolist() == [1 + 1 + 3, 0 + 3 + 3]
    assert language.ranked(np.array([1, 2, 3, 4]), np.array([5, 9, 5, 1]), 3).tolist() == [2, 1, 3]


def test_held_out_accuracy_and_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = id_crc32("doc_id") % 4 == 2
    profiles = language.train(docs.filter(~held))
    carry = {"doc_id": F.col("doc_id"), "held_out": held, "lang": F.col("lang")}
    rows = language.predict(docs, profiles, carry).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    split = language.predict(docs, profiles, carry, group=3).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in split} == {(r.doc_id, r.lang_pred, r.score) for r in rows}


def test_language_edges(spark):
    docs = edge_docs(spark)
    profiles = language.train(docs)
    rows = language.predict(docs, profiles, {"doc_id": F.col("doc_id"), "row": F.col("row")}).collect()
    assert len(rows) == len(ROWS)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (3, 4, 8))
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "und"}
    nothing = language.predict(docs, language.train(empty_docs(spark)), {"doc_id": F.col("doc_id")}).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(ROWS)
    assert language.predict(empty_docs(spark), profiles, {"doc_id": F.col("doc_id")}).count() == 0


def brute_ppm(rows, held, order):
    cnt, wc = defaultdict(Counter), Counter()
    edge = b"\xff"
    for i, t in rows:
        if not held(i):
            t = (t or "").encode()
            s = edge * order + t + edge
            for p in range(order, len(s)):
                for k in range(order + 1):
                    cnt[s[p - k:p]][s[p]] += 1
            wc.update([*t.lower().split(), b""])
    total, kinds = sum(wc.values()), len(wc)
    out = []
    for i, t in rows:
        t = (t or "").encode()
        s, score = edge * order + t + edge, 0.0
        for p in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                left = {b: n for b, n in cnt.get(s[p - k:p], {}).items() if b not in gone}
                if not left:
                    continue
                size = 2 * sum(left.values())
                if s[p] in left:
                    score += math.log10((2 * left[s[p]] - 1) / size)
                    break
                score += math.log10(len(left) / size)
                gone |= set(left)
            else:
                score += math.log10(1 / (256 - len(gone)))
        toks = [*t.lower().split(), b""]
        base = sum(math.log10((wc.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in toks)
        out.append((str(i), len(toks), sum(w in wc for w in toks), total, round(base, 6), round(score, 6)))
    return sorted(out)


def flat(rows):
    return sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in rows)


def test_ppm_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 1500")
    rows = [(r.doc_id, r.text) for r in docs.collect()][:60]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    for order, chars in ((2, 15_000), (5, 40_000)):  # several groups
        got = lm_score.score(df, id_crc32("doc_id") % 5 == 1, order=order, group_chars=chars).collect()
        assert flat(got) == brute_ppm(rows, held, order)
        assert {r.doc_id for r in got if r.held_out} == {i for i, _ in rows if held(i)}


def test_ppm_edges(spark, monkeypatch):
    docs = edge_docs(spark).filter("doc_id is null or doc_id <> 5")
    rows = [(r[0], r[1]) for r in ROWS if r[0] != 5]
    held = lambda i: i in (1, 7)
    flag = F.coalesce(F.col("doc_id").isin(1, 7), F.lit(False))
    assert flat(lm_score.score(docs, flag).collect()) == brute_ppm(rows, held, lm_score.ORDER)
    untrained = lm_score.score(docs, F.lit(True)).collect()
    assert {r.train_tokens for r in untrained} == {0} and len(untrained) == len(rows)
    assert lm_score.score(empty_docs(spark), F.lit(False)).count() == 0
    long = b"ab\xc3\xa9" * 50
    whole = np.concatenate(list(lm_score.windows(long)))
    monkeypatch.setattr(lm_score, "_CHUNK", 17)
    assert np.concatenate(list(lm_score.windows(long))).tolist() == whole.tolist() and len(whole) == len(long) + 1


def test_model_beats_unseen_noise(spark):
    rng = random.Random(0)
    train = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "mat"]) for _ in range(30))) for i in range(50)]
    test = [(100, "the cat sat on the mat"), (101, "qzx vkj wpf bnm gtr lpo")]
    df = spark.createDataFrame(train + test, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_score.score(df, F.col("doc_id") >= 100).collect()}
    assert got[100] > got[101] + 10


def test_lookup_finds_every_key():
    rng = np.random.default_rng(8)
    for n in (1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        table = lm_score.Lookup(keys, np.arange(len(keys)).astype(float))
        ask = rng.permutation(np.repeat(np.arange(len(keys)), 3))
        assert (table.get(keys[ask]) == ask).all()


def test_lm_group_counts_come_in_slices(monkeypatch):
    """A group's texts arrive in batches and its rows leave in slices, whatever the sizes."""
    texts = [(i, i % 3 == 0, f"word{i % 7} und noch {i} Wörter " * (i % 4)) for i in range(40)]
    frames = [pd.DataFrame({"doc_id": i, "held_out": [h], "text": [t], "grp": 5}) for i, h, t in texts]
    monkeypatch.setattr(lm_score, "_SLICE", 50)
    for chunk in (64, 1_000_000):
        monkeypatch.setattr(lm_score, "_CHUNK", chunk)
        parts = list(lm_score._group_counts(3)(iter(frames)))
        assert len(parts) > 3 and max(map(len, parts)) <= 50
        rows = pd.concat(parts)
        wins, terms, held = Counter(), Counter(), []
        for _, h, t in texts:
            found = np.concatenate(list(lm_score.windows(t.encode(), 3))).astype(np.int64).tolist()
            held += found if h else []
            wins.update([] if h else found)
            terms.update({w.decode(): 0 for w in lm_score.words(t.encode())} if h else
                         Counter(w.decode() for w in lm_score.words(t.encode())))
        wins.update({w: 0 for w in held})
        is_word = rows["word"].notna()
        assert dict(zip(rows["win"][~is_word], rows["n"][~is_word])) == wins and len(rows) == len(wins) + len(terms)
        assert dict(zip(rows["word"][is_word], rows["n"][is_word])) == terms and set(rows["grp"]) == {5}


def test_lm_scores_come_from_batches_in_any_order(spark, monkeypatch):
    """A group's texts, windows and words arrive mixed in small batches and its rows leave in slices; ids above
    2 ** 53 beside null ids stay whole."""
    texts = [(i, f"a{i % 3} b {'c' * (i % 5)}") for i in range(30)]
    wins = np.unique(np.concatenate([w for _, t in texts for w in lm_score.windows(t.encode(), 2)])).astype(np.int64)
    terms = sorted({w.decode() for _, t in texts for w in lm_score.words(t.encode())})
    rows = ([(lm_score._DOC, str(i), t, i % 2, 0.0) for i, t in texts] + [(lm_score._WINDOW, None, None, w, w / 7) for w in wins]
            + [(lm_score._KNOWN if len(w) < 3 else lm_score._UNKNOWN, None, w, 0, float(len(w))) for w in terms])
    random.Random(3).shuffle(rows)
    frames = [pd.DataFrame(rows[k:k + 11], columns=["kind", "doc_id", "text", "win", "val"]) for k in range(0, len(rows), 11)]
    monkeypatch.setattr(lm_score, "_SLICE", 7)
    parts = list(lm_score._score_group(2)(iter(frames)))
    assert len(parts) == 5 and max(map(len, parts)) == 7 and not list(lm_score._score_group(2)(iter([])))
    got = {r.doc_id: r for part in parts for r in part.itertuples()}
    for i, t in texts:
        toks, r = [w.decode() for w in lm_score.words(t.encode())], got[str(i)]
        assert (r.held, r.n_tokens, r.n_known, r.base_score) == (i % 2, len(toks), sum(len(w) < 3 for w in toks), sum(map(len, toks)))
        assert math.isclose(r.score, sum(w.astype(np.int64).sum() / 7 for w in lm_score.windows(t.encode(), 2)))
    monkeypatch.undo()
    ids = [2 ** 53 + 1, None, 2 ** 53 + 3]
    df = spark.createDataFrame([(i, "ab") for i in ids], "doc_id long, text string")
    out = lm_score.score(df, F.lit(False))
    assert {r.doc_id for r in out.collect()} == set(ids) and "FlatMapCoGroups" not in out._jdf.queryExecution().toString()
