"""Small fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from peerbench.operators.scenario import RATES


def ordered_labels(spark: SparkSession, labels: Sequence[str], name: str, sort: str) -> DataFrame:
    """Labels with their place, 1 for the first."""
    rows = [(label, place) for place, label in enumerate(labels, 1)]
    return spark.createDataFrame(rows, f"{name} string, {sort} int")


def scenario_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(rate,) for rate in RATES], "ReductionPct double")
