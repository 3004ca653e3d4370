"""Several named selections of one table evaluated together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio
from peerbench.operators.benchmark import observed_matched
from peerbench.operators.sketches import seeded_median


def by_selection(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """``df`` with a ``Selection`` column: one copy of a row for every label whose flag column is true."""
    labels = [F.when(F.col(flag), F.lit(label)) for label, flag in flags.items()]
    return df.withColumn("Selection", F.explode(F.array_compact(F.array(*labels))))


def selection_metrics(model: DataFrame, selections: dict[str, Column], entity: str) -> DataFrame:
    """One row per named selection with 14 metrics; an empty one has zero counts and blank values.

    Records are first reduced per combination of selections that they belong to; only these few rows are
    then copied to each of their selections.
    """
    flags = {label: f"_in{i}" for i, label in enumerate(selections)}
    rows = model.select(
        entity,
        "ExactLOS",
        "CostCents",
        "LOSCensored",
        "BenchmarkEligible",
        "ExpectedLOS",
        *[F.coalesce(p, F.lit(False)).alias(flags[label]) for label, p in selections.items()],
    )
    partial = rows.groupBy(*flags.values(), entity).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("ExactLOS").alias("_known"),
        F.sum("ExactLOS").alias("_days"),
        F.sum("CostCents").alias("_cost"),
        F.sum("LOSCensored").alias("_capped"),
        F.sum("BenchmarkEligible").alias("_matched"),
        observed_matched().alias("_observed"),
        F.sum("ExpectedLOS").alias("_expected"),
    )
    sums = (
        by_selection(partial, flags)
        .groupBy("Selection")
        .agg(
            F.sum("_n").alias("Discharges"),
            F.count_distinct(entity).alias("Hospitals"),
            ratio(F.sum("_days"), F.sum("_known")).alias("AvgExactLOS"),
            F.sum("_cost").alias("_cost"),
            F.sum("_capped").alias("CensoredStays"),
            F.sum("_matched").alias("MatchedDischarges"),
            F.sum("_observed").alias("ObservedMatchedDays"),
            F.sum("_expected").alias("ExpectedMatchedDays"),
        )
    )
    medians = seeded_median(
        rows,
        list(flags.values()),
        "CostCents",
        lambda finest: by_selection(finest, flags),
        ["Selection"],
    )
    labels = model.sparkSession.createDataFrame([(s,) for s in selections], "Selection string")
    observed = F.col("ObservedMatchedDays")
    # Every side has at most one row per selection that the caller named.
    joined = labels.join(sums, "Selection", "left").join(medians, "Selection", "left")
    return joined.select(
        "Selection",
        F.coalesce("Discharges", F.lit(0)).alias("Discharges"),
        F.coalesce("Hospitals", F.lit(0)).alias("Hospitals"),
        "AvgExactLOS",
        ((F.col("low") + F.col("high")).cast("double") / 200).alias("MedianEstimatedCost"),
        (F.col("_cost").cast("double") / 100).alias("EstimatedCost"),
        "CensoredStays",
        "MatchedDischarges",
        ratio(F.col("MatchedDischarges"), F.col("Discharges")).alias("BenchmarkCoverage"),
        "ObservedMatchedDays",
        "ExpectedMatchedDays",
        ratio(observed, F.col("ExpectedMatchedDays")).alias("LOSIndex"),
        (observed * F.lit(0.0)).alias("ScenarioBedDays_0pct"),
        (observed * F.lit(0.05)).alias("ScenarioBedDays_5pct"),
        (observed * F.lit(0.1)).alias("ScenarioBedDays_10pct"),
    )


SELECTION_METRICS = (
    "Discharges",
    "Hospitals",
    "AvgExactLOS",
    "MedianEstimatedCost",
    "EstimatedCost",
    "CensoredStays",
    "MatchedDischarges",
    "BenchmarkCoverage",
    "ObservedMatchedDays",
    "ExpectedMatchedDays",
    "LOSIndex",
    "ScenarioBedDays_0pct",
    "ScenarioBedDays_5pct",
    "ScenarioBedDays_10pct",
)


def long_form(metrics: DataFrame) -> DataFrame:
    """Selection, metric, value: one row per number."""
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in SELECTION_METRICS
    ]
    return metrics.select("Selection", F.explode(F.array(*pairs)).alias("_p")).select(
        "Selection", "_p.*"
    )
