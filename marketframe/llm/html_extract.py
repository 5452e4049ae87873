"""Main text of web pages by site style trees (Yi, Liu and Li, 2003).

Pages of a host are merged into one tree: a node is a style path (tags with their
classes and ids from the root), and counts say how often it occurs, with which
sequences of children (presentation) and over which texts (content). With m
pages in a node:

* presentation importance: entropy, base m, of the child sequences, 1 if m is 1;
* content importance: 1 - mean of log_m(pages that share the text), over the
  texts in the branch, so text of every page counts 0 and text of one page 1;
* composite importance: (1 - G) * presentation + G * content, with G = ``GAMMA`` to
  the number of child sequences; a node without children has only content.

A branch whose composite importance is below ``THRESHOLD`` is boilerplate and removed from
every page. On few pages little is known, so the threshold narrows by ``1 - 2 / m``: nothing is
removed on two pages (a page and its copy look alike), on three only what all of them share. Mark-up that names
its own role decides first: what is marked as menu, header, footer, sidebar,
notice, advert, form, script or comments goes whatever its entropy (such
texts may differ on every page), but not what is around the page's article. In an article or
main element the threshold is multiplied by the content importance of the whole articles
that the branch lies in: copies of an article are still articles, while a block that
different articles repeat goes.

The tree is never built in one task: parsing emits (host, path, kind, feature)
rows, and counts and entropies are two grouped sums with partial
aggregation, so a host with a third of the pages is spread like any other. Only
the removed paths of a host are gathered (template nodes) and joined to its
pages, which a salt deals to ``SALT`` tasks where the join shuffles.

Defined results: null and empty html give an empty text; a url without a host
puts the page in the group of hostless pages; repeated rows count as pages and
give a row each; ties do not arise (a block is in or out); whole pages of any length are read, a
long one in a batch of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dom
from .common import stage
from .tokens import text_batches

GAMMA = 0.9
THRESHOLD = 0.25
CONTENT, CHILDREN, WHOLE = 0, 1, 2
SALT = 16


def host_of(url_col: str) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST"))), F.lit(""))


def _source(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))


def features(html: str) -> set[tuple[int, int, int]]:
    """(path, kind, feature) of a page, each once: the texts in each branch and the
    child sequence of each element, and for branches in an article its whole text. Branches
    that are noise by their mark-up are left out."""
    blocks, elements = dom.walk(html)
    out = set()
    articles: dict[int, tuple[set[int], list[str]]] = {}
    for e, text in blocks:
        content = dom.digest(text)
        out.update((p, CONTENT, content) for p in e.paths())
        if e.main:
            top = e
            while top.parent.main:
                top = top.parent
            paths, texts = articles.setdefault(id(top), (set(), []))
            paths.update(e.paths()[:len(e.paths()) - len(top.parent.paths())])
            texts.append(text)
    for paths, texts in articles.values():
        whole = dom.digest(*texts)
        out.update((p, WHOLE, whole) for p in paths)
    for e in elements:
        if e.children and not e.noise and e.tag not in dom.PAGE:
            out.add((e.path, CHILDREN, dom.digest(*e.children)))
    return out


def style_tree(src: DataFrame) -> DataFrame:
    """(host, path, pages, importance, whole) of every style path below the body that is
    not noise by its mark-up; ``whole`` is the content importance of the whole articles
    that the branch lies in, 1 outside articles."""
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in text_batches(frame, "html"):
                rows = [(h, *f) for h, t in zip(frame["host"].iloc[a:b], frame["html"].iloc[a:b]) for f in features(t)]
                yield pd.DataFrame(rows, columns=["host", "path", "kind", "feature"])

    seen = src.select("host", "html").mapInPandas(parse, "host string, path long, kind int, feature long")
    n = seen.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("n"))
    x = F.col("n").cast("double")
    content, child, whole = (F.col("kind") == k for k in (CONTENT, CHILDREN, WHOLE))
    t = n.groupBy("host", "path").agg(
        F.sum(F.when(content, x)).alias("texts"), F.sum(F.when(content, x * F.log(x))).alias("text_nlogn"),
        F.sum(F.when(child, x)).alias("pages"), F.sum(F.when(child, x * F.log(x))).alias("child_nlogn"),
        F.count(F.when(child, x)).alias("styles"),
        F.sum(F.when(whole, x)).alias("wholes"), F.sum(F.when(whole, x * F.log(x))).alias("whole_nlogn"))
    # a leaf has no child sequences: its pages are counted by its texts
    m = F.coalesce("pages", "texts")
    base = F.log(F.greatest(m, F.lit(2.0)))
    text_imp = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("text_nlogn") / F.col("texts") / base)
    # entropy of p = n / m is log m - sum(n log n) / m
    child_imp = F.when(m > 1, (F.log(m) - F.col("child_nlogn") / m) / base).otherwise(F.lit(1.0))
    g = F.pow(F.lit(GAMMA), F.col("styles").cast("double"))
    both = F.when(F.col("styles") == 0, text_imp).otherwise(
        (F.lit(1.0) - g) * child_imp + g * F.coalesce(text_imp, F.lit(0.0)))
    one = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("whole_nlogn") / F.col("wholes") / F.log(F.greatest("wholes", F.lit(2.0))))
    return t.select("host", "path", m.cast("long").alias("pages"), both.alias("importance"),
                    F.when(F.col("wholes").isNull(), F.lit(1.0)).otherwise(one).alias("whole"))


def boilerplate(tree: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, paths): the removed branches of each host."""
    low = tree.filter(F.col("importance") < threshold * F.col("whole") * (F.lit(1.0) - F.lit(2.0) / F.col("pages")))
    return low.groupBy(F.col("host").alias("b_host")).agg(F.collect_list("path").alias("paths"))


def main_text(html: str, removed: frozenset[int]) -> str:
    """The page's blocks outside noise and ``removed`` branches, joined by an empty line."""
    blocks, _ = dom.walk(html)
    return "\n\n".join(text for e, text in blocks
                       if not removed or removed.isdisjoint(e.paths()))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    src = _source(pages, id_col, url_col, html_col)
    gone = stage(boilerplate(style_tree(src), threshold), "boilerplate")
    # staged, so a small table is broadcast by its size; otherwise the salt spreads the pages of a hot host
    gone = gone.withColumn("b_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = src.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)))
    j = salted.join(gone, (salted["host"] == gone["b_host"]) & (salted["salt"] == gone["b_salt"]), "left")
    j = j.select("page_id", "url", "html", "paths")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in text_batches(frame, "html"):
                part = frame.iloc[a:b]
                sets = [frozenset() if p is None else frozenset(p.tolist()) for p in part["paths"]]
                text = [main_text(h, s) for h, s in zip(part["html"], sets)]
                yield part[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    kinds = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return j.mapInPandas(run, f"{kinds}, text string, n_chars long")
