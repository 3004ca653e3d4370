"""Figures of a table, gathered by the job that writes it.

``stored_with`` writes a table like ``session.stored`` and observes aggregates of its rows on the way, so knowing
how many rows, cents or blanks a layer holds takes no further pass.  The figures are written beside the layer as a
table of one row.

The rows are observed behind the last shuffle, in the tasks that write them; Spark counts each such task once,
however often it had to be run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from peerbench.session import CODEC, fresh_path, tidied


def stored_with(df: DataFrame, name: str, figures: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The written table, and its figures (name -> aggregate) as a table of one row written beside it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    observation = Observation(name)
    aggregates = [aggregate.alias(figure) for figure, aggregate in figures.items()]
    with tidied(spark):
        df.observe(observation, *aggregates).write.parquet(path, compression=CODEC)
    # The types of the figures; this plan is never run.
    schema = df.agg(*aggregates).schema
    found = observation.get
    row = spark.createDataFrame([tuple(found[field.name] for field in schema)], schema)
    row.coalesce(1).write.parquet(f"{path}-figures")
    return spark.read.schema(df.schema).parquet(path), spark.read.schema(schema).parquet(f"{path}-figures")


def blanks(columns: list[str], prefix: str = "blank_") -> dict[str, Column]:
    """A figure per column: how many of its values are NULL or empty."""
    return {f"{prefix}{c}": F.count(F.when(F.coalesce(F.col(c), F.lit("")) == "", 1)) for c in columns}


def bounds(columns: list[str]) -> dict[str, Column]:
    """Two figures per column: its smallest and its largest value."""
    found = {}
    for c in columns:
        found |= {f"least_{c}": F.min(c), f"most_{c}": F.max(c)}
    return found


def long_figures(figures: DataFrame, layer: str) -> DataFrame:
    """``layer``, ``figure``, ``value`` (text): a row per figure."""
    pairs = [F.struct(F.lit(c).alias("figure"), F.col(c).cast("string").alias("value")) for c in figures.columns]
    return figures.select(F.lit(layer).alias("layer"), F.explode(F.array(*pairs)).alias("_p")).select("layer", "_p.*")
