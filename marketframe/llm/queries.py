"""The queries of this subpackage: one per operator, over its whole table, and
their DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, conv_repair, decontaminate, divergence, exact_dedup, html_extract, language, lm_score, mixing, oracles,
               packing, quality, simhash, token_files)
from .common import id_crc32, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    q = quality.quality(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return q.select("row.doc_id", *[F.col(f"stats.{c}") for c in
                                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    "base_failed", "kept")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    out = packing.pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in a mix with tempered source weights, in the rounded
    shares of a period that its SQL has."""
    return mixing.mix(table(spark, sf_dir, "documents"), slots=mixing.SLOTS)


#: Speaker markers of the transcripts made from the conversations, by style and role.
MARKER_STYLES = (("System: ", "User: ", "Assistant: "), ("Instructions: ", "Human: ", "AI: "),
                 ("### System: ", "### User: ", "### Assistant: "), ("<|system|>", "<|user|>", "<|assistant|>"))


def transcript_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts as a chat log has them: the turns' lines in order, most turns
    introduced by a speaker marker in their transcript's style, about a quarter
    without one. (conv_id, turn, line, role, text); turn and role are the labels."""
    t = table(spark, sf_dir, "conversations")
    styles = F.array(*[F.array(*[F.lit(m) for m in s]) for s in MARKER_STYLES])
    style = F.get(styles, F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKER_STYLES))).cast("int"))
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    mark = F.when(bare, F.lit("")).otherwise(F.coalesce(F.get(style, chat.role_index(F.col("role"))), F.lit("")))
    lines = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "part")
    return t.select("conv_id", "turn", "role", mark.alias("mark"), lines).select(
        "conv_id", "turn", "line", "role",
        F.when(F.col("line") == 0, F.concat("mark", "part")).otherwise(F.col("part")).alias("text"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered turns of every transcript; the model learns from the conversations
    whose crc32(conv_id as text) mod 5 is not 1."""
    lines = transcript_lines(spark, sf_dir)
    model = chat.fit(chat.labelled(lines.filter(id_crc32("conv_id") % 5 != 1)))
    parsed = chat.parse(lines.select("conv_id", "turn", "line", "text"), model, order=["turn", "line"])
    return chat.turns(parsed).select("conv_id", "turn", "role", "n_lines", "text", "rendered")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document under a model of those not held out."""
    return lm_score.score(table(spark, sf_dir, "documents"), id_crc32("doc_id") % 5 == 1)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document, read back from the files."""
    return token_files.write_and_read(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and survivor of every document's text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs, held_out = table(spark, sf_dir, "documents"), id_crc32("doc_id") % 4 == 2
    profiles = language.train(docs.filter(~held_out))
    return language.predict(docs, profiles, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with rows dropped, emptied, cut, repeated or given to the user, by a
    checksum of their id and turn."""
    t = table(spark, sf_dir, "conversations")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    t = t.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return t.filter(F.col("kind") != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every damaged conversation."""
    edited, solved = conv_repair.repair(damaged_conversations(spark, sf_dir))
    convs = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("conv")).distinct()
    return conv_repair.report(convs, edited, solved).withColumnRenamed("conv", "conv_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most divergent terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in every document."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_rules, op2_best_fit_packing, op3_source_mixing, op4_chat_formatting, op5_lm_scoring, op6_token_files,
    op7_simhash, op8_exact_dedup, op9_language_id, op10_html_extraction, op11_conversation_repair,
    op12_source_divergence, op13_benchmark_decontamination)}

ORACLE: dict[str, str] = {
    "op1_quality_rules": oracles.QUALITY,
    "op3_source_mixing": oracles.MIX,
    "op8_exact_dedup": oracles.EXACT,
    "op11_conversation_repair": oracles.REPAIR,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op13_benchmark_decontamination": oracles.LEAKS,
}
