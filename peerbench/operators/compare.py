"""Comparisons of two result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import within


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with multiplicity, found on one side only; empty when both hold the same rows."""
    b = b.select(*a.columns)
    left = a.exceptAll(b).withColumn("side", F.lit("left"))
    return left.unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def compare_values(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str, tolerance: float
) -> DataFrame:
    """Full outer comparison by key: both values and whether they agree within ``tolerance``.

    A key that only one side has does not pass, whatever its value.
    """
    left = expected.select(*keys, F.col(value).alias("expected"), F.lit(True).alias("_in_expected"))
    right = actual.select(*keys, F.col(value).alias("actual"), F.lit(True).alias("_in_actual"))
    both = F.col("_in_expected").isNotNull() & F.col("_in_actual").isNotNull()
    return left.join(right, list(keys), "full").select(
        *keys,
        "expected",
        "actual",
        (both & within(F.col("expected"), F.col("actual"), tolerance)).alias("passed"),
    )


def value_gaps(found: DataFrame, listed: DataFrame) -> DataFrame:
    """``field``, ``unlisted``, ``unused``, ``repeated``: for every listed field how many found values are not
    listed, how many listed values are not found, and how many are listed more than once.

    Both sides have ``field`` and ``value`` (text); NULL is a value.
    """
    a = found.select("field", "value").distinct().withColumn("_found", F.lit(True))
    b = listed.groupBy("field", "value").agg(F.count(F.lit(1)).alias("_copies"))
    b = b.withColumnsRenamed({"field": "_field", "value": "_value"})
    same = (F.col("field") == F.col("_field")) & F.col("value").eqNullSafe(F.col("_value"))
    both = a.join(b, same, "full").withColumn("field", F.coalesce("field", "_field"))
    return both.groupBy("field").agg(
        F.count(F.when(F.col("_copies").isNull(), 1)).alias("unlisted"),
        F.count(F.when(F.col("_found").isNull(), 1)).alias("unused"),
        F.count(F.when(F.col("_copies") > 1, 1)).alias("repeated"),
    )
