"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes what a stage
returns as Parquet into the shared checkpoint folder and reads it back for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import curriculum, hyperminhash, line_dedup, packing, quality_rules
from panelwright.llm.common import ensure_checkpoint_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality policy rejects."""
    return quality_rules.kept(docs, "v2")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines found in ten or more documents, but for the first place that has them: a text with many copies stays
    once. Documents stay, though all their lines may go."""
    return line_dedup.deduplicated(docs, min_docs=10, keep="first")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates (85 % of five-word shingles in common)."""
    return hyperminhash.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources: a row for each time a document is taken, in training order."""
    return curriculum.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all rows with their sequence and place."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mixing", mixing), ("packing", packed)]
#: Near-duplicate search, tokenizing and packing are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
