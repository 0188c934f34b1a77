"""The corpus pipeline: five operators over ``documents``, one after the other.

Each stage reads what the one before it has written (Parquet in the shared
folder), so a lost executor costs a stage's tasks and never the stages before.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrascore.llm import decontaminate, line_dedup, minhash_join, mixing, toxicity
from terrascore.llm.common import read_table, stage_table

#: SQL cannot express the trained classifier of the first stage; the stages are
#: tested one by one against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain judges toxic go."""
    chain = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, chain)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are equal or similar, across all documents, one stays."""
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8) one stays."""
    return minhash_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row per repetition of a document."""
    return mixing.materialise(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
