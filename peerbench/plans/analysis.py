"""The six analysis queries over the stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import rounded_ratio
from peerbench.operators.benchmark import entity_sums, index, sensitivity, whole_sum
from peerbench.operators.median import median_cents, narrowed_median, ranked_median
from peerbench.plans.lake import Lake
from peerbench.plans.layout import ENTITY, ENTITY_FIELDS, STRATA


def _activity(model: DataFrame, by: Sequence[str]) -> DataFrame:
    return model.groupBy(*by).agg(
        F.count(F.lit(1)).alias("Discharges"),
        F.sum("ExactLOS").alias("_days"),
        F.count("ExactLOS").alias("_known"),
        whole_sum("CostCents").alias("_cost"),
        F.count("CostCents").alias("_priced"),
    )


def _mean_stay() -> Column:
    return rounded_ratio(F.col("_days"), F.col("_known"), 2).alias("AvgExactLOS")


def _mean_cost() -> Column:
    # Whole cents first, so that half a cent is rounded up exactly.
    return (rounded_ratio(F.col("_cost"), F.col("_priced"), 0) / 100).alias("AvgEstimatedCost")


def by_condition(lake: Lake) -> DataFrame:
    """Discharges, mean stay, total and mean cost per condition, costliest first."""
    sums = _activity(lake.model, ["ConditionDescription"])
    return sums.select(
        "ConditionDescription",
        "Discharges",
        _mean_stay(),
        (F.col("_cost").cast("double") / 100).alias("EstimatedCost"),
        _mean_cost(),
    ).orderBy(F.desc("EstimatedCost"), "ConditionDescription")


def supported_entities(lake: Lake) -> DataFrame:
    """Hospitals with enough matched records, highest index first."""
    least = lake.domain.min_matched
    matched = F.col("MatchedDischarges")
    shown = entity_sums(lake.model, ENTITY_FIELDS).filter(matched >= least)
    standard = index(matched, F.col("MatchedObservedDays"), F.col("MatchedExpectedDays"), least)
    return shown.select(
        "HospitalName",
        "Discharges",
        "MatchedDischarges",
        rounded_ratio(F.col("MatchedDischarges") * 100, F.col("Discharges"), 2).alias("CoveragePct"),
        rounded_ratio(F.col("ExactDays"), F.col("ExactLOSDischarges"), 2).alias("AvgExactLOS"),
        F.round(standard, 3).alias("LOSIndex"),
    ).orderBy(F.desc("LOSIndex"), "HospitalName")


def by_severity(lake: Lake) -> DataFrame:
    """Discharges, mean stay and mean cost per condition and severity."""
    by = ["ConditionDescription", "SeverityKey", "Severity"]
    sums = _activity(lake.model, by)
    return sums.select(*by, "Discharges", _mean_stay(), _mean_cost()).orderBy(*by[:2])


def median_cost(lake: Lake, ranked: bool = False) -> DataFrame:
    """Exact median of the positive costs per condition."""
    by = ["ConditionKey", "ConditionDescription"]
    method = ranked_median if ranked else narrowed_median
    medians = method(lake.model.filter(F.col("CostCents") > 0), by, "CostCents")
    return medians.select(
        "ConditionDescription", median_cents(F.col("low"), F.col("high")).alias("MedianEstimatedCost")
    )


def by_disposition(lake: Lake) -> DataFrame:
    """Discharges and mean stay per disposition, most frequent first."""
    sums = _activity(lake.model, ["Disposition"])
    return sums.select("Disposition", "Discharges", _mean_stay()).orderBy(
        F.desc("Discharges"), "Disposition"
    )


def sensitivity_index(lake: Lake, min_peers: int = 30) -> DataFrame:
    """Index without deaths and long stays, peers rebuilt, beside the primary index."""
    base = lake.records.filter(lake.domain.sensitivity_base())
    rebuilt = sensitivity(
        base, lake.summary(), ENTITY, STRATA, "ExactLOS", lake.domain.min_matched, min_peers
    )
    return rebuilt.orderBy(F.desc("SensitivityLOSIndex"), ENTITY)
