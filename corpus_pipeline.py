"""The corpus pipeline: documents to packed training sequences, in stages.

Every stage takes what its predecessor kept and returns the columns of ``documents``, the last one pieces.
Defined results, as of the operators: a null or empty text has no words, so the quality rules drop it; of equal
texts the row with the largest id stays, of near copies that with the smallest; rows without an id are told apart by
their text; null languages and sources are groups of their own; texts of any length are whole; an empty table
passes through all stages as empty; other columns are carried along, whatever their names. The near-duplicate stage takes
the SimHash operator's contract (3-word shingles, 3 bits), which links exact and very near copies only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import exact_dedup, mixing, packing, quality, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the adaptive thresholds."""
    return quality.drop_low_quality(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by SimHash."""
    return simhash.drop_near(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the mixed order; the files written from it hold that order."""
    return mixing.mixed(docs)


def stored_order(docs: DataFrame) -> list[Column] | None:
    """The order of rows in the files that ``docs`` was read from; None where it
    was not read from files."""
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return None
    return order


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences packed along the mixed order: (doc_id, piece, start, length,
    ids_crc32, sequence_id, offset)."""
    return packing.pack_documents(docs, order=stored_order(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", best_fit),
]

#: Packing is not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the
    shared folder and read again as the input of the next."""
    from marketframe.llm.common import stage
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
