"""Star schema: one fact table, dimensions that filter and label it, and its key checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.session import stored


def dimension(df: DataFrame, key: str, attributes: Sequence[str] = ()) -> DataFrame:
    """Distinct key with attributes."""
    return df.select(key, *attributes).distinct()


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def surplus_numbers(df: DataFrame, key: str) -> DataFrame:
    """``rows`` and ``repeated``: how many rows of a table of whole numbers repeat one from another row.

    Numbers from 1 on are counted as bits, so the shuffle holds a bit per number, not a row.
    """
    number = F.col(key).cast("bigint")
    bitmaps = df.where(number.isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number))).alias("found"),
    )
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    return bitmaps.agg(rows.alias("rows"), (rows - F.coalesce(F.sum("found"), F.lit(0))).alias("repeated"))


def duplicate_texts(df: DataFrame, key: str) -> DataFrame:
    """As ``duplicate_keys`` for one long key: digests are counted first, and texts only where one occurs again."""
    digest = F.xxhash64(key).alias("_digest")
    counts = df.groupBy(digest).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
    again = stored(counts, "digests-again")
    return duplicate_keys(df.select(key, digest).join(again, "_digest", "left_semi"), [key])


@dataclass(frozen=True)
class Star:
    """A fact with its dimensions: name -> (table, key column).

    Every key has one row in its dimension.  Labelling relies on it, so it refuses a key with more.
    """

    fact: DataFrame
    dims: dict[str, tuple[DataFrame, str]]

    def _home(self, attribute: str) -> tuple[DataFrame, str]:
        for table, key in self.dims.values():
            if attribute in table.columns:
                return table, key
        raise KeyError(f"no dimension has the column {attribute!r}")

    def select(self, selection: dict[str, Sequence]) -> "Star":
        """Keep fact rows whose dimension rows carry one of the chosen values, for every attribute."""
        fact = self.fact
        for attribute, values in selection.items():
            table, key = self._home(attribute)
            chosen = table.filter(F.col(attribute).isin(list(values))).select(key)
            fact = fact.join(chosen, key, "left_semi")
        return Star(fact, self.dims)

    def label(self, attributes: Sequence[str]) -> DataFrame:
        """Fact rows with the named dimension attributes beside them; only dimensions in use are joined."""
        wanted: dict[str, tuple[DataFrame, list[str]]] = {}
        for attribute in attributes:
            if attribute in self.fact.columns:
                continue
            table, key = self._home(attribute)
            wanted.setdefault(key, (table, []))[1].append(attribute)
        labelled = self.fact
        for key, (table, names) in wanted.items():
            labels = table.select(F.col(key).alias("_key"), *names)
            labelled = labelled.join(_single(labels), F.col(key) == F.col("_key"), "left").drop("_key")
        return labelled


def _single(labels: DataFrame) -> DataFrame:
    """One row per ``_key``; the query fails if a key has several."""
    names = [c for c in labels.columns if c != "_key"]
    message = F.concat(F.lit("a dimension has several rows for key "), F.col("_key").cast("string"))
    kept = F.when(F.col("_copies") == 1, F.col("_row")).otherwise(F.raise_error(message).cast(labels.select(F.struct(*names)).schema[0].dataType))
    rows = labels.groupBy("_key").agg(F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*names)).alias("_row"))
    return rows.select("_key", kept.alias("_row")).select("_key", "_row.*")
