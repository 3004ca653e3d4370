"""Sharding by a two-pass external shuffle.

The first pass scatters the records uniformly into buckets that fit in memory, by a seeded hash of the place of
each record in the table; the second puts every bucket in the order of the hashes, shuffles it (Fisher-Yates, with
a generator seeded by the number of the bucket) and writes it.  All buckets one after another are then one random
order of the table, and the shards are equal stretches of it: their counts differ by one at most.

The number of buckets follows the bytes of text, and each task has the same number of them.  A bucket learns where
it starts from a row of its own that travels with its records, so nothing is broadcast or joined.  Equal records,
equal ids and equal texts are dealt out like any others, since the hash is of the place.

``place`` tells records apart; for a table read from Parquet, ``file_place`` gives file and row, which stay the same
however the table is split into tasks, so the same files and seed give the same shards.  Without it the number of the
record within its task is taken, and the records should come from a written table.

Null ids and texts are kept as they are; a null or empty text counts as size 1.  An empty table gives empty shards,
of which no file is written.  A record longer than a bucket makes its bucket larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from peerbench.llm.common import utf8
from peerbench.operators.ordering import running
from peerbench.session import fresh_path, stored

SHARDS = 16
SEED = 13
# Bytes of text in a bucket; the second pass holds two buckets' worth in a worker.
BUCKET_BYTES = 32 << 20
# Bytes that a worker gives back at a time.
BATCH_BYTES = 1 << 20


def file_place(docs: DataFrame) -> Column:
    """File name and row number of a record, for a table read from files."""
    meta = docs.metadataColumn("_metadata")
    return F.struct(meta["file_name"], meta["row_index"])


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("bigint")


def permutation(seed: int, bucket: int, count: int) -> np.ndarray:
    """A Fisher-Yates shuffle of the numbers below ``count``."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(count)


def shuffled(batches: Iterator[pa.RecordBatch], seed: int, shards: int, total: int) -> Iterator[pa.RecordBatch]:
    """Records sorted by bucket and draw, each bucket led by the row of its start, in their final order."""

    def finish(bucket: int, parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        held = pa.concat_tables(parts)
        start = held.column("start")[0].as_py()
        order = permutation(seed, bucket, held.num_rows - 1)
        place = start + np.arange(len(order))
        shard = place * shards // total
        # The first place of shard s is the least whose s-th part has been reached.
        slot = place - -(-shard * total // shards)
        rows = held.column("row").combine_chunks().take(pa.array(order + 1))
        whole = pa.table({"shard": pa.array(shard.astype(np.int32)), "slot": pa.array(slot), "row": rows})
        # Small batches, since both sides hold a batch outside of their managed memory.
        yield from whole.to_batches(max_chunksize=max(1, whole.num_rows * BATCH_BYTES // max(1, whole.nbytes)))

    bucket, parts = None, []
    for batch in batches:
        numbers = np.asarray(batch.column("bucket"))
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if numbers[a] != bucket and parts:
                yield from finish(bucket, parts)
                parts = []
                pa.default_memory_pool().release_unused()
            bucket = int(numbers[a])
            parts.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if parts:
        yield from finish(bucket, parts)


def shuffled_shards(
    docs: DataFrame,
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    place: Column | None = None,
) -> DataFrame:
    """``shard`` (from 0), ``slot`` (place in the shard, from 0) and ``row``, the record with all its columns."""
    spark = docs.sparkSession
    place = F.monotonically_increasing_id() if place is None else place
    drawn = F.xxhash64(F.lit(seed), place)
    total, size = docs.agg(F.count(F.lit(1)), F.sum(size_of(F.col(text_col)))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of_task = max(1, -(-(size or 0) // (bucket_bytes * tasks)))
    # The hash is used from the top for the bucket and whole for the order, so both are uniform.
    bucket = F.pmod(F.shiftright(drawn, 16), F.lit(of_task * tasks))
    counts = stored(docs.select(bucket.alias("bucket")).groupBy("bucket").count(), "shard-buckets")
    ends = running(counts, [], [F.col("bucket")], ["count"])
    starts = ends.select("bucket", F.lit(0).cast("bigint").alias("draw"), (F.col("cum_count") - F.col("count")).alias("start"))
    records = docs.select(
        bucket.alias("bucket"), drawn.alias("draw"), F.lit(None).cast("bigint").alias("start"), F.struct("*").alias("row")
    )
    kind = records.schema["row"].dataType
    both = records.unionByName(starts.withColumn("row", F.lit(None).cast(kind)))
    # A task has neighbouring buckets, so it writes to one or two shards.
    task = F.call_function("div", F.col("bucket"), F.lit(of_task)).cast("int")
    dealt = both.repartitionById(tasks, task).sortWithinPartitions("bucket", F.col("start").isNull(), "draw")
    result = StructType().add("shard", IntegerType()).add("slot", LongType()).add("row", kind)
    return dealt.drop("draw").mapInArrow(lambda batches: shuffled(batches, seed, shards, total), result)


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the records in shuffled order to a folder per shard and return the written table."""
    found = shuffled_shards(docs, **options)
    found.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def shard_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", place: Column | None = None) -> DataFrame:
    """``id_col``, size, text_crc32, law, shard, slot and grown_shard of every record, read from written shards.

    The law is ``rows``: the counts of the shards differ by one at most, and another shard moves records everywhere,
    so ``grown_shard`` is null.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    written = write_shards(chosen, fresh_path(docs.sparkSession, "shards"), place=place)
    text = F.col("row.text")
    return written.select(
        F.col("row.id").alias(id_col),
        size_of(text).alias("size"),
        F.crc32(utf8(text)).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
