"""Exact dedup by a heavy-hitter split.

Texts are compared by SHA-256 of their UTF-8 bytes. A Misra-Gries pass
(Spark's ``freqItems``, which keeps ``1 / support`` counters) names every digest
that holds more than ``support`` of the rows, and maybe a few others. One
counting pass verifies these candidates; the verified winners, at most
``1 / support`` rows, are broadcast and their copies resolved on the map side,
so a digest with a third of the table is never shuffled to one task. The
remaining digests, each below ``support`` of the rows, are grouped by an
ordinary shuffle with partial aggregation.

Only (id, digest) pairs are staged and shuffled, never texts.

Defined results: a null text counts as empty; a null id sorts below every
other id (it stays only among rows without any id); rows repeated with the
same id and text are one group of which exactly one row stays; texts of any length are
hashed whole, and only digests are compared; an empty table gives no rows; other columns are carried through and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SUPPORT = 0.001


def text_digest(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)


def heavy_digests(rows: DataFrame, digest: str, support: float = SUPPORT) -> DataFrame:
    """Digests held by ``support`` of the rows or more, as one column; at most
    ``1 / support`` rows. ``rows`` should be a staged table: it is read twice."""
    cand = (rows.stat.freqItems([digest], support)
                .select(F.explode(F.col(f"{digest}_freqItems")).alias(digest)))
    total = rows.count()
    counted = (rows.join(F.broadcast(cand), digest, "left_semi")
                   .groupBy(digest).agg(F.count(F.lit(1)).alias("_n")))
    return stage(counted.filter((F.col("_n") >= 2) & (F.col("_n") >= F.lit(support * total))).select(digest), "heavy")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (largest id of its equal
    texts), group_size, kept (true for exactly one row of each group) and
    text_sha256."""
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256"))
                     .withColumn("rid", F.monotonically_increasing_id()), "digests")
    heavy = heavy_digests(rows, "text_sha256", support)
    best = [F.max(F.struct("doc_id", "rid")).alias("best"), F.count(F.lit(1)).alias("group_size")]
    hot = rows.join(F.broadcast(heavy), "text_sha256", "left_semi")
    winners = stage(hot.groupBy("text_sha256").agg(*best), "winners")
    rest = rows.join(F.broadcast(heavy), "text_sha256", "left_anti")
    out = (rows.join(F.broadcast(winners), "text_sha256")
               .unionByName(rest.join(rest.groupBy("text_sha256").agg(*best), "text_sha256")))
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                      (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               support: float = SUPPORT) -> DataFrame:
    """``docs`` without the rows whose text equals that of a row with a larger
    id; of rows repeated with the same id and text one stays. All columns of
    ``docs`` are returned unchanged.

    Losers of heavy digests go on the map side; the other rows are shuffled
    once by digest, with the best row of each digest taken before the shuffle
    already (Spark's group limit for ``row_number() = 1``)."""
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest")), "digests")
    heavy = heavy_digests(rows, "digest", support)
    winners = stage(rows.join(F.broadcast(heavy), "digest", "left_semi")
                        .groupBy(F.col("digest").alias("h_digest")).agg(F.max("doc_id").alias("h_id")), "winners")
    wide = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
    j = wide.join(F.broadcast(winners), F.col("digest") == F.col("h_digest"), "left")  # 1 / support rows at most
    j = j.filter(F.col("h_digest").isNull() | F.col("id").eqNullSafe(F.col("h_id")))
    best = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    return j.withColumn("r", F.row_number().over(best)).filter("r = 1").select("row.*")
