"""The registered queries of the subpackage: name -> function of a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm import collocations, mixing
from peerbench.llm import secrets as secret_scan
from peerbench.llm.byte_bpe import encode_digests
from peerbench.llm.common import table
from peerbench.llm.embeddings import near_duplicate_vectors
from peerbench.llm.langid import identify
from peerbench.llm.periodic import run_digests, with_periodic_tails
from peerbench.llm.pii import pseudonyms
from peerbench.llm.quality import judge
from peerbench.llm.sharding import file_place, shard_digests
from peerbench.llm.simhash import near_duplicates
from peerbench.llm.token_counts import count_tokens
from peerbench.llm.toxicity import classify

Query = Callable[[SparkSession, str], DataFrame]


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("_id", "doc_id").drop("_text")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(table(spark, sf_dir, "documents"))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select(
        F.col("_id").alias("doc_id"), fingerprint.alias("fingerprint"), F.col("component").alias("component_id")
    )


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(with_periodic_tails(table(spark, sf_dir, "documents")))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return shard_digests(docs, place=file_place(docs))


QUERIES: dict[str, Query] = {
    "op1_language_id": language,
    "op2_quality_rules": quality,
    "op3_secrets": secrets,
    "op4_mixing": mixing_sources,
    "op5_embeddings": embeddings,
    "op6_token_counts": token_counts,
    "op7_byte_bpe": byte_bpe,
    "op8_pii": pii,
    "op9_simhash": simhash,
    "op10_toxicity": toxicity,
    "op11_collocations": phrases,
    "op12_periodic_runs": repetitions,
    "op13_sharding": sharding,
}

ORACLE: dict[str, str] = {
    "op3_secrets": secret_scan.oracle(),
    "op4_mixing": mixing.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
