"""Numbering and running totals over ordered rows without a single-task window.

The rows are range-partitioned and sorted, written to the shared folder together with their partition
number, and every partition learns from a tiny per-partition summary where it starts.  Running totals need a
second shuffle, by range number: each range is a task, whatever the size of the largest group.
``order`` (within ``by``) must be unique; aggregate first where it is not.  Choosing the ranges reads the rows
an extra time, so store what is costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerbench.session import stored

# Low bits of monotonically_increasing_id(): the row's place inside its partition.
_PLACE_MASK = (1 << 33) - 1


def placed_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows of ``df`` in order, with the number of their range and their place in it, to be written.

    Choosing the ranges reads ``df`` an extra time.  Row-by-row projections that keep the columns ``_part`` and
    ``_place`` may follow before the rows are written, nothing else.
    """
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)).alias("_place"),
            "*",
        )
    )


def place_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Write the rows of ``df`` in order, with the number of their range and their place in it."""
    return stored(placed_rows(df, order), name)


def number_rows(placed: DataFrame, name: str) -> DataFrame:
    """Rows written by ``place_rows`` with ``name``: 1..n over the whole table."""
    # One row per range, so this window and the broadcast below are bounded by the number of ranges.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_place") + 1).alias(name),
        *[c for c in placed.columns if c not in ("_part", "_place")],
    )


def row_key(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: 1..n in the given order, dense over the whole table."""
    return number_rows(place_rows(df, order, f"ordered-{name}"), name)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    sums: Sequence[str],
    position: str = "position",
    prefix: str = "cum_",
) -> DataFrame:
    """Add the 1-based position within ``by`` and a running total of every column in ``sums``."""
    placed = place_rows(df, [*[F.col(c) for c in by], *order], "running")
    totals = [F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]]
    parts = placed.groupBy("_part", *by).agg(*totals)
    before = (
        Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = parts.select(
        "_part",
        *by,
        F.sum("_n").over(before).alias("_n_before"),
        *[F.sum(f"_sum_{c}").over(before).alias(f"_before_{c}") for c in sums],
    ).filter(F.col("_n_before").isNotNull())
    # Only a group that continues from an earlier range has something to carry: at most one per range.
    carried = F.broadcast(carried.toDF(*[f"_c{c}" if c in (*by, "_part") else c for c in carried.columns]))
    same = F.col("_part") == F.col("_c_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_c{c}"))
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    zero = F.lit(0)
    # Every range is a task of its own: the number of the range is the number of the partition.
    ranges = (placed.agg(F.max("_part")).first()[0] or 0) + 1
    return (
        placed.repartitionById(ranges, "_part").select(
            "*",
            F.row_number().over(inside).cast("bigint").alias("_inside"),
            *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in sums],
        )
        .join(carried, same, "left")
        .select(
            *df.columns,
            (F.col("_inside") + F.coalesce("_n_before", zero)).alias(position),
            *[
                (F.col(f"_inside_{c}") + F.coalesce(f"_before_{c}", zero)).alias(f"{prefix}{c}")
                for c in sums
            ],
        )
    )


def every_kth(df: DataFrame, order: Sequence[Column], parts: int = 25) -> DataFrame:
    """Systematic sample: every k-th row in order, with k so that about ``parts`` rows remain.

    The sample has fewer than ``2 * parts`` rows whatever the size of ``df``.
    """
    numbered = stored(row_key(df, order, "_number"), "numbered")
    step = max(1, numbered.count() // parts)
    return numbered.filter((F.col("_number") - 1) % step == 0).drop("_number")
