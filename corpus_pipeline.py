"""Documents to training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of documents. No stage can be written in SQL as a whole, so the result is tested against the stages' brute-force
versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import pii, quality, simhash, wu_manber
from tillworks.llm.common import table
from tillworks.llm.queries import pack_documents
from tillworks.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weak-label scorer keeps: readable and not abusive."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, by the fingerprints and bits of op10.

    Of rows that share that id one stays. Rows without id cannot be told apart from others: they stay if no row of
    their group has an id, else the one with the id does.
    """
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark."""
    return wu_manber.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the personal data of their texts masked and their length brought up to date."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_pii),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{number}")
    return docs
