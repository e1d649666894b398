"""Training-corpus pipeline: quality rules, line dedup, near-duplicate dedup,
PII sanitisation and packing, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cathlake.llm import lines, minhash, packing, pii, quality
from cathlake.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate across sites."""
    return with_length(lines.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.keep_one(docs)


def pii_sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    return with_length(pii.sanitise(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack(docs)


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought in line with the text, where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup), ("pii", pii_sanitised),
          ("packing", packed)]

ORACLE_SQL = None  # the later stages have no SQL form; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "pipeline")
    return docs
