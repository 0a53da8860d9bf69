"""From raw documents to token ids: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontamination, line_templates, sentencepieces, simhash, toxicity
from tidewatch.llm.common import shared_root, table
from tidewatch.llm.queries import tokenizer_path
from tidewatch.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(prepare(spark), sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents go."""
    return line_templates.drop_recurring_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document left, and digests of ids and decoded text."""
    return sentencepieces.encode_decode(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# The classifier, the fingerprints and the tokenizer have no SQL; tests/llm compares with plain Python.
ORACLE_SQL = None
