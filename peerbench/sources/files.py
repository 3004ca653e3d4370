"""File listings, digests and manifests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.session import task_count

# Bytes read at a time while hashing.
CHUNK = 8 << 20

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, bytes, modified of every file under ``path``; no file content is read."""
    kept = spark.conf.get(LISTING_TASKS)
    # A task for each of many small folders takes far longer to start than to list.
    spark.conf.set(LISTING_TASKS, str(min(int(kept), 4 * spark.sparkContext.defaultParallelism)))
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    finally:
        spark.conf.set(LISTING_TASKS, kept)
    return listing.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )


def file_digests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, bytes, sha256 of every file under ``path``.

    Files are spread over tasks, and each is read in chunks: a task never holds a whole file.
    """
    chunk_bytes = CHUNK

    # Defined here so that it travels to the workers by value.
    def hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for uri in batch["path"]:
                system, place = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
                digest = hashlib.sha256()
                with system.open_input_stream(place) as stream:
                    while chunk := stream.read(chunk_bytes):
                        digest.update(chunk)
                digests.append(digest.hexdigest())
            yield batch.assign(sha256=digests)

    files = list_files(spark, path).select("path", "bytes")
    # The list is small and the files are not, so the number of tasks is fixed.
    return files.repartition(task_count(spark, 0), "path").mapInPandas(
        hash_files, "path string, bytes bigint, sha256 string"
    )


def relative_to(files: DataFrame, root: str) -> DataFrame:
    """Paths relative to ``root``."""
    inside = "^.*?" + "/+".join(_quoted(part) for part in root.strip("/").split("/")) + "/+"
    return files.withColumn("path", F.regexp_replace("path", inside, ""))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_-" else "\\" + c for c in text)


def verify_manifest(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Files under ``root`` against a manifest of path, bytes, sha256.

    ``status`` is ok, missing, extra, size or hash; every path of either side has one row.
    """
    actual = relative_to(file_digests(spark, root), root).select(
        "path", F.col("bytes").alias("actual_bytes"), F.col("sha256").alias("actual_sha256")
    )
    listed = manifest.select(
        "path",
        F.col("bytes").cast("bigint").alias("expected_bytes"),
        F.col("sha256").alias("expected_sha256"),
    )
    status = (
        F.when(F.col("actual_sha256").isNull(), "missing")
        .when(F.col("expected_sha256").isNull(), "extra")
        .when(F.col("actual_bytes") != F.col("expected_bytes"), "size")
        .when(F.col("actual_sha256") != F.col("expected_sha256"), "hash")
        .otherwise("ok")
    )
    return listed.join(actual, "path", "full").withColumn("status", status)


def snapshot_state(spark: SparkSession, path: str | list[str]) -> str:
    """A mark of the files under a path that changes when one is added, removed or rewritten."""
    state = list_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"),
        F.bit_xor(F.xxhash64("path", "bytes", "modified")).alias("mark"),
    )
    row = state.first()
    return f"{row['files']}-{row['mark']}"
