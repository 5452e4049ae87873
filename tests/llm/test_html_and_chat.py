import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from marketframe.llm import chat, dom, html_extract, queries
from marketframe.llm.common import id_crc32


def text_of(html):
    return html_extract.main_text(html, frozenset())


def test_blocks_entities_and_broken_markup():
    assert text_of("<main><p>A &amp; B&#33;<br>d <b>e</b>f</p>\n<ul><li>1<li>2</ul></main>") == "A & B! d ef\n\n1\n\n2"
    assert text_of("<p><b>one<br><p>two</p>") == "one\n\ntwo"
    assert text_of("<p>cut &am") == "cut &am" and text_of("<p>cut &amp") == "cut &"
    assert text_of("<p>x</p><scr") == "x" and text_of("<p>x<!-- y") == "x"
    assert text_of("<article><p>a < b<script>if(a<b){'</p>'}</script>c") == "a < bc"
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>d") == "a\n\nb\n\nc\n\nd"
    assert text_of("<P Class='x>y'>q</P>") == "q" and text_of("") == "" and text_of("plain") == "plain"


def test_named_parts_of_a_page_go():
    page = ("<html><head><title>t</title><style>s</style></head><body class='has-sidebar'><header>h</header>"
            "<nav>n</nav><div class='cookie-notice'>c</div><div id=sidebar>s</div><article><header><h1>T</h1></header>"
            "<p>one</p><p>two <span class=ad>AD</span>three</p><form>f</form><div hidden>z</div></article>"
            "<section class=comments><article class=comment>hey</article></section><div role=contentinfo>i</div>"
            "<footer>&copy;</footer></body></html>")
    assert text_of(page) == "T\n\none\n\ntwo three"


def test_a_word_around_the_article_does_not_drop_it():
    article = "<article><h1>T</h1><p>one</p></article>"
    side = "<div class=sidebar><article><p>teaser</p></article></div><div class='cookie-notice'>c</div>"
    comments = "<section class=comments><article class='comment-body'><p>hey</p></article></section>"
    for wrap in ("class='content-with-sidebar'", "class='layout-sidebar-right'", "id='search-page'"):
        assert text_of(f"<body><div {wrap}>{article}</div></body>") == "T\n\none"
        assert text_of(f"<body><div {wrap}><div class=x-widget>{side}w</div>{article}{comments}</div></body>") == "T\n\none"
        assert text_of(f"<main><div {wrap}>{article}</div></main>") == "T\n\none"
        assert text_of(f"<div {wrap}><main><p>m</p></main><div class=ad>a</div></div>") == "m"
    assert text_of(f"{article}{side}{comments}") == "T\n\none"
    assert text_of("<div role=search><article>a</article></div>b") == "b"  # a role is the author's own statement


def pages(host, n):
    body = ("<div class=top>Welcome to our site</div><div class=body><h2>Title {i}</h2><p>Own words number {i}.</p>"
            "<p>More of page {i}.</p></div><div class=legal><p>All rights reserved.</p></div>")
    return [(i, f"http://{host}/p/{i}", f"<html><body>{body.format(i=i)}</body></html>") for i in range(n)]


def test_style_tree_removes_repeated_branches_only(spark):
    rows = pages("a.example", 30) + [(1000 + i, f"http://one{i}.example/x", h) for i, (_, _, h) in enumerate(pages("x", 3))]
    copies = [(2000 + i, f"http://copy.example/{i}", "<body><article><p>Same article.</p></article></body>") for i in range(20)]
    df = spark.createDataFrame(rows + copies, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    for i in range(30):
        assert got[i] == f"Title {i}\n\nOwn words number {i}.\n\nMore of page {i}."
    assert got[1000].startswith("Welcome to our site") and got[1000].endswith("All rights reserved.")
    assert all(got[2000 + i] == "Same article." for i in range(20))  # copies of an article stay
    tree = html_extract.style_tree(html_extract._source(df, "page_id", "url", "html")).filter("host = 'a.example'").collect()
    low = [r for r in tree if r.importance < html_extract.THRESHOLD]
    assert len(tree) > len(low) >= 2 and all(0 <= r.importance <= 1 for r in tree)


def test_repeated_blocks_in_articles_go_and_copied_articles_stay(spark):
    page = "<body><{t}><h1>Title {i}</h1><p>Own {i}.</p><p>More {i}.</p><div class=about><p>Written by our staff.</p></div></{t}></body>"
    rows = [(100 * k + i, f"http://{t}.example/{i}", page.format(t=t, i=i)) for k, t in enumerate(("article", "main")) for i in range(30)]
    rows += [(1000 + i, f"http://copies.example/{i}", page.format(t="article", i=min(i, 3))) for i in range(40)]  # 37 of one text
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    for k, i in itertools.product((0, 1), range(30)):
        assert got[100 * k + i] == f"Title {i}\n\nOwn {i}.\n\nMore {i}."
    for i in range(40):
        assert got[1000 + i].startswith(f"Title {min(i, 3)}\n\nOwn {min(i, 3)}.\n\nMore {min(i, 3)}.")


def test_extract_edges(spark):
    rows = [(1, None, "<p>a</p>", "x"), (2, "no url", None, "x"), (None, "http://h/", "", "x"), (1, None, "<p>a</p>", "x"),
            (3, "http://h:8080/?q=[", "<p>" + "word " * 100_000 + "</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("paths", F.lit(1))
    got = html_extract.extract(df).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 1), ("1", 1), ("2", 0), ("3", 499_999), ("None", 0)]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_extract_articles_of_test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in df.collect()}
    got = html_extract.extract(df).collect()
    assert len(got) == len(html)
    for r in got:  # brute force: nothing outside the article element, all inside
        inner = html[r.page_id].split("<article>")[1].split("</article>")[0]
        assert r.text == text_of("<article>" + inner) and r.n_chars == len(r.text)
    assert dom.walk("<article><p>x")[0][0][0].main


# ------------------------------------------------------------------ chat

def small_model(seed=0):
    rng = np.random.default_rng(seed)
    n, s = chat.STATES, chat.SYMBOLS
    return chat.Model(rng.integers(0, 9, n).astype(float), rng.integers(0, 9, (n, n)).astype(float),
                      rng.integers(0, 9, (n, s)).astype(float))


def test_viterbi_against_all_paths():
    for seed in range(5):
        m = small_model(seed)
        symbols = np.random.default_rng(seed).integers(0, chat.SYMBOLS, 5)
        moves = m.moves(symbols, True)
        score = lambda p: moves[0][0, p[0]] + sum(moves[i][p[i - 1], p[i]] for i in range(1, 5))
        best = max(itertools.product(range(chat.STATES), repeat=5), key=score)
        assert abs(score(best) - score(tuple(chat.best_path(moves, 0, None)))) < 1e-9
        assert np.allclose(chat.chain(moves)[0].max(), score(best))


def test_blocks_of_a_long_transcript_give_the_same_path(spark):
    symbols = np.random.default_rng(1).integers(0, chat.SYMBOLS, 400).tolist()
    lines = spark.createDataFrame([(c, i, s) for c in (1, None) for i, s in enumerate(symbols)],
                                  "conv long, pos long, symbol int")
    m = small_model()
    whole = {(r.conv, r.pos): r.state for r in chat.decode(lines, m).collect()}
    moves = m.moves(np.array(symbols), True)
    assert [whole[1, i] for i in range(400)] == chat.best_path(moves, 0, None)
    cut = {(r.conv, r.pos): r.state for r in chat.decode(lines, m, block=7, fan=3).collect()}
    score = lambda d, c: moves[0][0, d[c, 0]] + sum(moves[i][d[c, i - 1], d[c, i]] for i in range(1, 400))
    assert len(cut) == 800 and all(abs(score(cut, c) - score(whole, c)) < 1e-6 for c in (1, None))


def test_markers(spark):
    lines = ["User: hi", "### Assistant: x", "<|system|>be nice", "[human] a", "Human: b", "Bob Smith: c", "users: d",
             "http://x", "", "plain text", None]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select(
        "i", chat.marker(F.coalesce("t", F.lit(""))).alias("m"), chat.unmarked(F.coalesce("t", F.lit(""))).alias("u"))
    got = {r.i: (chat.MARKERS[r.m], r.u) for r in df.collect()}
    assert [got[i][0] for i in range(11)] == ["user", "assistant", "system", "user", "user", "name", "none", "none", "none",
                                              "none", "none"]
    assert [got[i][1] for i in range(5)] == ["hi", "x", "be nice", "a", "b"]


def test_roles_of_held_out_conversations(spark):
    sf = "/root/testdata/sf0.01"
    lines = queries.transcript_lines(spark, sf)
    model = chat.fit(chat.labelled(lines.filter(id_crc32("conv_id") % 5 != 1)))
    parsed = chat.parse(lines.select("conv_id", "turn", "line", "text"), model, order=["turn", "line"])
    truth = {}
    for r in sorted(lines.collect(), key=lambda r: (r.conv_id, r.turn, r.line)):
        truth.setdefault(r.conv_id, []).append(r.role)
    rows = parsed.collect()
    assert len(rows) == sum(map(len, truth.values()))
    held = [r for r in rows if zlib.crc32(str(r.conv_id).encode()) % 5 == 1]
    assert sum(truth[r.conv_id][r.pos] == r.role for r in held) >= 0.9 * len(held)
    turns = chat.turns(parsed).collect()
    assert sum(t.n_lines for t in turns) == len(rows)
    assert all(t.rendered == f"<|{t.role}|>\n{t.text}\n<|end|>\n" for t in turns)


def test_parse_edges(spark):
    model = chat.Model(np.zeros(6), np.zeros((6, 6)), np.zeros((6, chat.SYMBOLS)))
    df = spark.createDataFrame([(None, 1, None, 0), (None, 1, "User: hi", 0), (3, 1, "", 0), (3, 1, "", 0), (4, None, "x", 0)],
                               "conv_id long, line_no int, text string, state int")
    out = chat.parse(df, model).collect()
    assert len(out) == 5 and {r.conv_id for r in out} == {None, 3, 4}
    assert chat.turns(chat.parse(df.limit(0), model)).count() == 0


def test_odd_mark_up_keeps_the_text():
    from marketframe.llm.html_extract import main_text
    text = lambda html: main_text(html, frozenset())
    assert text("<p class=it's>Hello world</p><p>That's all folks</p><p>End</p>") == "Hello world\n\nThat's all folks\n\nEnd"
    assert text("<p>H<nobr>2</nobr>O is <my-term>water</my-term> here</p>") == "H2O is water here"
    assert text("<p>See <svg><g><text>ICON</text></g></svg> here</p>") == "See here"
    assert text("<p>See <svg><foreignObject><p>ICON</p></foreignObject></svg> here</p>").startswith("See")
    assert text('<p title="a > b" data-x=\'1 < 2\'>one</p><p title=a"b>two</p>') == "one\n\ntwo"
    assert text('<p title="never closed>one</p><p>two</p>').endswith("two")
    assert text("<div class='layout-sidebar-right'><p>The whole story of the page is here.</p></div><p>by X</p>") == \
        "The whole story of the page is here.\n\nby X"
    assert text("<p>A story that is long enough to be one.</p><div class='sidebar'><p>Links</p></div>") == \
        "A story that is long enough to be one."


def test_composite_importance_against_brute_force(spark):
    import math
    from collections import Counter, defaultdict

    from marketframe.llm import html_extract as H
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<body><div class='a'><p>text {i % 3}</p><p>own {i}</p></div>"
              f"<div class='b'><p>same</p>{'<b>x</b>' if i % 4 else ''}</div><article><p>art {i % 5}</p></article></body>") for i in range(18)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.host, r.path): (r.pages, r.importance, r.whole) for r in
           H.style_tree(H._source(df, "page_id", "url", "html")).collect()}
    seen = defaultdict(Counter)
    for i, _, html in pages:
        for path, kind, feature in H.features(html):
            seen[f"h{i % 2}.org", path, kind][feature] += 1
    want = {}
    for host, path in {k[:2] for k in seen}:
        texts, kids, wholes = (seen[host, path, k] for k in (H.CONTENT, H.CHILDREN, H.WHOLE))
        m = sum(kids.values()) or sum(texts.values())
        base = math.log(max(m, 2))

        def content(c, base):
            return max(0.0, 1 - sum(n * math.log(n) for n in c.values()) / sum(c.values()) / base) if c else 0.0
        entropy = -sum(n / m * math.log(n / m) for n in kids.values()) / base if m > 1 else 1.0
        g = H.GAMMA ** len(kids)
        imp = (1 - g) * entropy + g * content(texts, base) if kids else content(texts, base)
        whole = content(wholes, math.log(max(sum(wholes.values()), 2))) if wholes else 1.0
        want[host, path] = (m, imp, whole)
    assert got.keys() == want.keys()
    for k, (m, imp, whole) in want.items():
        assert got[k][0] == m and abs(got[k][1] - imp) < 1e-9 and abs(got[k][2] - whole) < 1e-9


def test_one_marker_of_a_line_goes(spark):
    from pyspark.sql import functions as F

    from marketframe.llm import chat
    lines = ["User: AI: hello", "AI: User: hello", "### System: be kind", "Human: hi", "no marker", "<|user|>System: x", "Bob: hi"]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    got = [r.u for r in df.select(chat.unmarked(F.col("t")).alias("u")).collect()]
    assert got == ["AI: hello", "User: hello", "be kind", "hi", "no marker", "System: x", "Bob: hi"]
