"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkyield.llm import bpe, catalog, decontaminate, lines, quality, simhash
from sparkyield.llm.common import benchmark, checkpointed, documents


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits of their host go from the others."""
    judged = quality.apply_rules(docs, left=True).where("kept")
    return _counted(judged.select(*docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines one stays; documents without a line left go."""
    return _counted(lines.deduplicate(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    A null id is the last; among rows with the smallest id the one with the smallest
    text hash stays, and among equal rows one.
    """
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, benchmark(spark, sf_dir))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of their decoded text."""
    return bpe.digests(docs, catalog.byte_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL can express neither the similarity of lines nor the token ids
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
