"""Registered queries of the operators, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm import centroids, digest, html_text, language, line_dedup, mixing, negatives, packing, pii, quality, simhash, top_k, toxicity
from stayspark.llm.common import table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its lines, how many of them were later copies, and the text without those."""
    rows = line_dedup.deduplicate(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("dedup_lines").alias("n_lines"), F.col("dedup_removed").alias("n_removed"), "text")


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.summary(table(spark, folder, "documents"))


def op3_quartile_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.compare_with_following(table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("qr_tie")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.predict_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.assign(table(spark, folder, "documents").select("doc_id", "text", "source"))
    rows = rows.withColumn("position", F.array_min(F.transform("mix_copies", lambda c: c["position"])))
    # Documents that are not taken have no position; the id spreads them over the ranges.
    return rows.orderBy("position", "doc_id").select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 3).alias("target"),
        F.col("mix_taken").alias("taken"),
        F.round("position", 2).alias("first_position"),
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.predict_languages(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op11_pivot_distance(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(table(spark, folder, "embeddings"))


def op12_threshold_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_quartile_digest": op3_quartile_digest,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_language": op9_language,
    "op10_html_text": op10_html_text,
    "op11_pivot_distance": op11_pivot_distance,
    "op12_threshold_centroids": op12_threshold_centroids,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op6_mixing": mixing.ORACLE,
    "op11_pivot_distance": top_k.ORACLE,
    "op12_threshold_centroids": centroids.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
