"""Documents to packed training sequences: quality rules, line and near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayspark.llm import line_dedup, mixing, near, packing, quality
from stayspark.llm.common import DOCUMENT_COLUMNS, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.keep(docs).select(*DOCUMENT_COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; a document left without a word goes."""
    return line_dedup.remove_copies(docs).select(*DOCUMENT_COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word Jaccard similarity of 0.8 at least.

    SimHash fingerprints that meet at anchors give the first links, an exact prefix filter those beyond their radius.
    """
    return near.keep_one(docs).select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order, one row per copy of a document."""
    return mixing.mix(docs).select(*DOCUMENT_COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Token ids, robust estimates and XXH64 majorities are beyond SQL; tests hold each stage against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{number}")
    return docs
