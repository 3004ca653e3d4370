"""Helpers shared by the operators: reading tables, slicing Arrow batches, UTF-8 text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# Bytes of text that a worker handles at a time; one longer text makes a slice of its own.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; 0 for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % modulus, F.lit(0))


def utf8(text: Column) -> Column:
    """The text as UTF-8 bytes, empty for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices with about ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a binary column; bytes that are not UTF-8 become U+FFFD, null becomes empty."""
    return [(raw or b"").decode("utf-8", "replace") for raw in batch.column(column).to_pylist()]


def output(batch: pa.RecordBatch, kept: list[str], **columns) -> pa.RecordBatch:
    """A batch with columns of ``batch`` first and then new ones (arrays or lists)."""
    arrays = [batch.column(name) for name in kept]
    arrays += [x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, [*kept, *columns])


def worker_store(spark: SparkSession) -> Broadcast:
    """An empty dict that every Python worker gets once and keeps while it lives.

    What a worker puts there (tables read from a file, bounded caches) serves all tasks it runs.
    """
    return spark.sparkContext.broadcast({})


def kept_in(store: Broadcast, make: Callable[[], T]) -> T:
    """The worker's own object in ``store``, made when first asked for."""
    if "made" not in store.value:
        store.value["made"] = make()
    return store.value["made"]
