import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from marketframe.llm import packing, token_files
from marketframe.llm.common import shared_folder
from marketframe.llm.tokens import default_tokenizer, encoder
from tests.llm.edge import LONG, ROWS, edge_docs, empty_docs

ODD = ["", " ", "x<|endoftext|>", "a <|endoftext|> b <|endoftext|>", "<|endoftext|><|endoftext|>c  d", "|endoftext|", "  ", "a  b", "a \n b", "\n\n a", " a", "a ", "a   ", "x  y 　z", "<|endoftext|> hi", "don't  'll do\t\tit ",
       "a\x85 b \x1c c", "½ ² 12 3", "é  è\n \n x", "\tq", "q \t", " 's 't", "a   b", "日本 語"]


def true_ids(texts):
    out = Tokenizer.from_file(default_tokenizer()).encode_batch(texts, add_special_tokens=False)  # as the file has it
    return [x.ids for x in out]


def test_chunked_encoding_equals_whole_texts():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(["a", "B", " ", " ", "\n", "é", ".", "1", "\t", "'s", " "]) for _ in range(80))
                   for _ in range(200)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder(default_tokenizer()).encode(texts)]
    assert got == true_ids(texts)


def check_packed(rows, texts_by_id, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for doc, texts in texts_by_id.items():
        ids = [x + [2] for x in true_ids(texts)]
        want = sorted((s, n, zlib.crc32(np.array(x[s:s + n], "<u4").tobytes()))
                      for x in ids for s, n in packing.cut(len(x), capacity))
        assert sorted((r.start, r.length, r.ids_crc32) for r in by_doc[doc]) == want
    return len(by_seq)


def texts_by_id():
    out = {}
    for r in ROWS:
        out.setdefault(r[0], []).append(r[1] or "")
    return out


def test_pack_documents_edges(spark):
    rows = packing.pack_documents(edge_docs(spark)).collect()
    check_packed(rows, texts_by_id(), 1024)
    assert packing.pack_documents(empty_docs(spark)).count() == 0


def test_packers_windows_and_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = packing.pack_documents(docs, with_ids=True, capacity=256, per_task=100)
    rows = packed.collect()
    n = check_packed(rows, {r.doc_id: [r.text] for r in docs.collect()}, 256)
    assert n <= 1.05 * sum(r.length for r in rows) / 256 + 4
    seqs = packing.sequences(packed.select("*")).collect()
    assert sum(s.n_tokens for s in seqs) == sum(r.length for r in rows)
    assert all(len(s.ids) == 4 * s.n_tokens for s in seqs)


def test_open_bins_is_best_fit_and_bounded():
    bins = packing.OpenBins(10, limit=2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # fills the fuller one
    assert bins.place(9) == (2, 0) and bins.open == 2
    assert bins.place(8) == (3, 0) and bins.open == 2  # sequence 2, the fullest, closed
    assert bins.place(1) == (3, 8) and bins.place(4) == (0, 6)
    rng, big, used = random.Random(0), packing.OpenBins(1024, 8192), 0
    for _ in range(5000):
        n = rng.randint(1, 1024)
        big.place(n)
        used += n
    assert big.made <= 1.05 * used / 1024


def test_elias_fano_select_and_decode():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 255, 256, 257, 2000):
        for high in (1, 6, 10 ** 4, 10 ** 12):
            v = np.sort(rng.integers(0, high, n))
            e = token_files.EliasFano.encode(v)
            assert [int(e.select(i)[0]) for i in range(n)] == v.tolist()
            for a, b in ((0, n), (n // 3, n), (n // 2, n // 2 + 1), (1, n - 1)):
                assert a >= b or b > n or e.select(a, b).tolist() == v[a:b].tolist()
            assert e.directory.dtype == np.uint32
    e = token_files.EliasFano.encode(np.arange(0, 10 ** 6, 100))
    assert 8 * (len(e.low) + len(e.high)) <= 10 * e.n  # far below 64 bits a document


def test_token_files_round_trip(spark):
    docs = edge_docs(spark)
    rows = token_files.write_and_read(docs, shard_tokens=64, task_bytes=200).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = {t: x + [2] for t, x in zip([r[1] or "" for r in ROWS], true_ids([r[1] or "" for r in ROWS]))}
    assert len(rows) == len(ROWS)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [r[0] for r in order]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    want = sorted((r[0] is not None, r[0] or 0, len(ids[r[1] or ""]),
                   zlib.crc32(np.array(ids[r[1] or ""], "<u4").tobytes())) for r in ROWS)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert token_files.write_and_read(empty_docs(spark)).count() == 0


def test_shard_random_access(spark):
    folder = shared_folder(spark, "shard-test")
    docs = spark.createDataFrame([(9, "b c"), (4, "a"), (11, LONG)], "doc_id long, text string")
    manifest = token_files.write(docs, folder)
    assert manifest.agg({"tokens": "sum"}).first()[0] == sum(len(x) + 1 for x in true_ids(["b c", "a", LONG]))
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).collect():
        shard = token_files.Shard(bytes(r.content))
        for i, d in enumerate(shard.doc_ids()):
            assert shard.ids(i).tolist() == true_ids([{9: "b c", 4: "a", 11: LONG}[d]])[0] + [2]


def test_files_of_lost_attempts_are_not_read_and_go(spark):
    folder = shared_folder(spark, "shard-attempts")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    first = token_files.write(docs, folder, task_bytes=300)
    names = {r.shard for r in first.collect()}
    again = token_files.write(docs, folder, task_bytes=300)  # as tasks that run once more after a loss
    mine = {r.shard for r in again.collect()}
    assert not names & mine
    stored = {r.name for r in token_files._files(spark, folder).select("name").collect()}
    assert stored == mine
    assert token_files.read(spark, folder, again).count() == 20


def test_columns_keep_the_order_of_texts():
    texts = ["a b", "x<|endoftext|>", "", "a  b", "b a"] * 3
    ids, sizes = encoder(default_tokenizer()).columns(texts)
    want = true_ids(texts)
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_bounds_keep_the_order_and_split_rows_that_are_alike():
    rng = random.Random(3)
    keys = sorted((rng.choice([token_files.NO_ID, 3, 3, 3, rng.randint(0, 50)]), rng.choice([5, 5, rng.randint(-9, 9)])) for _ in range(2000))
    b = token_files.Bounds(keys[100::100])
    part = b.parts(np.array([k[0] for k in keys]), np.array([k[1] for k in keys])).tolist()
    assert set(part) <= set(range(20)) and len(set(part)) == 20
    by = sorted(zip(part, keys))                       # partitions one after the other, sorted inside
    assert [k for _, k in by] == keys
