"""The corpus pipeline: documents to token ids in stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and returns the documents that go on, with their columns; the last one
returns the token ids' digests.  A null text is empty: it fails the quality rules and goes.  Columns beyond those
named here are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.byte_bpe import encode_digests
from peerbench.llm.mixing import mixed_rows
from peerbench.llm.pii import pseudonymised
from peerbench.llm.quality import keep_good
from peerbench.llm.simhash import one_of_each
from peerbench.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the rules certified on the labels."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id."""
    return one_of_each(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data and the length of the new text in n_chars."""
    hidden = pseudonymised(docs)
    return hidden.withColumn("n_chars", F.length("text").cast(hidden.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed_rows(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document of the mix."""
    return encode_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("privacy", privacy),
    ("mixing", mixing),
    ("encoding", encoding),
]

# Quality verdicts, fingerprints and ids cannot be had from SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = fresh_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
