import hashlib
import heapq
import random

from marketframe.llm import conv_repair as R
from tests.llm.edge import edge_docs, empty_docs

STEP = {"": ("u", "s"), "s": ("u",), "u": ("a",), "a": ("u",)}
LONG = {"u": "user", "a": "assistant"}


def brute(rows):
    """rows: (role, text) in order -> (blank, duplicate, truncated, illegal, cost, audit, lines), by
    a search over (cost, audit) from the first row on."""
    seen, must, cut, n = set(), [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        core = text.strip(" \t\n\x0b\f\r")
        fault = ("blank" if not core else "duplicate" if (role, text) in seen else
                 "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            n[fault] += 1
        must.append(fault in ("blank", "duplicate"))
        cut.append(fault == "truncated")
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return (*n.values(), illegal, cost, audit, "\n".join(lines))
        if (i, last) in done:
            continue
        done.add((i, last))
        new = STEP[last][0]
        heapq.heappush(heap, (cost + 2, audit + "I", i, new, (*lines, f"{LONG[new]}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if not must[i]:
                if role[:1] and role[0] in STEP[last]:
                    heapq.heappush(heap, (cost + cut[i], audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + cut[i], audit + "R", i + 1, new, (*lines, f"{LONG[new]}:{text}")))


def run(spark, convs, block):
    data = [(c, i, role, text) for c, rows in convs.items() for i, (role, text) in enumerate(rows)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    edited, solved = R.repair(df, block=block)
    ids = spark.createDataFrame([(c,) for c in convs], "conv long")
    return {r.conv: r for r in R.report(ids, edited, solved).collect()}


def test_auction_prices_and_blocks_agree_with_brute_force(spark):
    rng = random.Random(5)
    convs = {}
    for c in range(120):
        n = rng.choice([0, 1, 2, 3, 5, 8, 13, 40])
        convs[c] = [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]),
                     rng.choice(["", " \n", "a.", "b!", "cut", "x y?", f"t{rng.random()}."])) for _ in range(n)]
    want = {c: brute(rows) for c, rows in convs.items()}
    for block in (3, 64):
        got = run(spark, convs, block)
        for c, (blank, dup, cut, illegal, cost, audit, lines) in want.items():
            r = got[c]
            assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (blank, dup, cut, illegal, cost, audit), c
            assert r.repaired_sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_prices_are_dual_feasible_and_tight_on_the_path():
    letters = "uUaas1u2oAAuS"
    arcs = R.lattice(letters, R.ACCEPT, True)
    price = [0] * len(arcs)
    cost = R.auction(arcs, price, 0)
    assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) for _, c, j in out)
    (found, edits, _), = R.solve(letters)
    assert found == cost
    i, total = 0, 0
    for e in edits:
        _, c, j = next(a for a in arcs[i] if a[0] == e)
        assert price[i] == c + price[j]
        i, total = j, total + c
    assert total == cost and i % 4 in (R.START, R.ASSISTANT)


def test_one_long_conversation_is_cut_into_blocks(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["user", "assistant"]), f"{i}{rng.choice('.,')}") for i in range(700)]
    got = run(spark, {1: rows}, 64)[1]
    want = brute(rows)
    assert (got.cost, got.audit) == want[4:6]


def test_turn_gaps_order_and_nulls(spark):
    data = [(None, 3, "assistant", "b."), (None, None, "user", "a."), (None, 5, None, "c."), (2, None, "user", None)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    edited, solved = R.repair(df)
    out = {r.conv: r for r in R.report(df.selectExpr("conv_id AS conv").distinct(), edited, solved).collect()}
    a, b = out[None], out[2]
    assert (a.gaps, a.audit, a.cost, a.illegal) == (1, "KKD", 3, 1)
    assert (b.gaps, b.blank, b.audit, b.repaired_sha256) == (0, 1, "D", hashlib.sha256(b"").hexdigest())


def test_edge_rows_and_empty_tables(spark):
    edited, solved = R.repair(edge_docs(spark), "lang", "doc_id", "source", "text")
    assert edited.count() == edge_docs(spark).count()
    edited, solved = R.repair(empty_docs(spark), "lang", "doc_id", "source", "text")
    ids = empty_docs(spark).selectExpr("lang AS conv")
    assert edited.count() == 0 and R.report(ids, edited, solved).count() == 0
