"""Catalogue tables: bucketed by the keys that joins and sums use, partitioned by what filters choose, and pages.

A table that is bucketed and sorted by entity and stratum is joined with another one of the same buckets, and summed
by these keys, without a shuffle.  A partition column gives every value a folder, so a filter on it, or on a dimension
joined to it, reads only these folders, and single values can be written anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.operators.ordering import number_rows, place_rows
from peerbench.session import CODEC, fresh_path, sized, stored, tidied


def unique_name(name: str) -> str:
    """A table name that this catalogue does not have yet."""
    return f"peerbench_{name}_{uuid.uuid4().hex}"


def save_bucketed(
    df: DataFrame, name: str, by: Sequence[str], buckets: int | None = None, partition: Sequence[str] = ()
) -> DataFrame:
    """Save as a table in the shared folder, bucketed and sorted by ``by``; every bucket is one task and one file
    (one per partition value)."""
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition columns come last in a table.
    ordered = df.select(*[c for c in df.columns if c not in partition], *partition)
    writer = ordered.repartition(count, *by).write.format("parquet").option("path", fresh_path(spark, name))
    writer = writer.option("compression", CODEC)
    if partition:
        # Kept with the table: an overwrite replaces only the partitions that it brings.
        writer = writer.partitionBy(*partition).option("partitionOverwriteMode", "dynamic")
    with tidied(spark):
        writer.bucketBy(count, *by).sortBy(*by).saveAsTable(name)
    return spark.table(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Write anew the partitions of a saved table that ``df`` has rows of; all others stay."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    with tidied(spark):
        df.select(*columns).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def store_partitioned(df: DataFrame, name: str, partition: Sequence[str]) -> DataFrame:
    """Write to the shared folder with a folder per value of ``partition``."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with tidied(spark):
        df.repartition(*partition).write.partitionBy(*partition).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Pages:
    """A table in the order of a unique key, in files of disjoint key ranges, and the key range of every page."""

    table: DataFrame
    ranges: DataFrame
    key: str

    def read(self, page: int) -> DataFrame:
        """The rows of one page (0 is the first): a range filter that reaches the files; empty beyond the last page."""
        row = self.ranges.where(F.col("page") == page).first()
        if row is None:
            return self.table.where(F.lit(False))
        return self.table.where(F.col(self.key).between(row["first_key"], row["last_key"]))


def paged(df: DataFrame, key: str, page_rows: int) -> Pages:
    """Write ``df`` in the order of ``key``; pages have ``page_rows`` rows, the last one perhaps fewer."""
    with sized(df.sparkSession, df.count()):
        placed = place_rows(df, [F.col(key)], "pages-placed")
    numbered = number_rows(placed, "_number")
    page: Column = F.call_function("div", F.col("_number") - 1, F.lit(page_rows))
    ranges = numbered.groupBy(page.alias("page")).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("rows")
    )
    # The placed rows are in ranges of the key already, one file each.
    return Pages(placed.drop("_part", "_place"), stored(ranges, "page-ranges"), key)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
