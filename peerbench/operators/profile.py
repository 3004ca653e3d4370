"""Descriptive profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.session import stored


def repeated_rows(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """How often the visible fields (all but ``exclude``) repeat beyond their first occurrence."""
    visible = [c for c in df.columns if c not in exclude]
    # Digests of 128 bits go through the first shuffle; whole rows only where a digest occurs again.
    marked = df.select(*visible, F.xxhash64(*visible).alias("_a"), F.xxhash64(F.lit(1), *visible).alias("_b"))
    digests = stored(marked.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n")), "row-digests")
    again = digests.where("n > 1").select("_a", "_b")
    whole = marked.join(again, ["_a", "_b"], "left_semi").groupBy(*visible).agg(F.count(F.lit(1)).alias("n"))
    copies = whole.select("n").unionByName(digests.where("n = 1").select("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_rows"),
    )


def blank_counts(df: DataFrame) -> DataFrame:
    """One row per column of an all-text table: number of blank values, from a single pass."""
    blank = df.agg(
        *[F.count(F.when(F.coalesce(F.col(c), F.lit("")) == "", 1)).alias(c) for c in df.columns]
    )
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).alias("blanks")) for c in df.columns]
    return blank.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def group_counts(df: DataFrame, by: Sequence[str], name: str = "discharges") -> DataFrame:
    """Rows per group, blanks as one NULL group, largest first."""
    keys = [F.nullif(F.col(c), F.lit("")).alias(c) for c in by]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), *[F.col(c).asc_nulls_first() for c in by])

