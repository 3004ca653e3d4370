"""The queries behind each report visual: group columns, measures and tooltip measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerbench.operators.pareto import pareto
from peerbench.operators.scenario import scenario_bridge, scenario_days, selected_rate
from peerbench.plans.layout import STAY_BANDS
from peerbench.plans.measures import evaluate
from peerbench.sources.literals import ordered_labels

# The explain-by columns of the decomposition, in their first order.
DECOMPOSITION = ("Condition", "Severity", "AgeGroup", "HospitalCounty", "HospitalName")


def activity_cards(model: DataFrame) -> DataFrame:
    return evaluate(model, ["Discharges", "Hospitals", "AvgLOS", "MedianEstimatedCost"])


def comparison_cards(model: DataFrame) -> DataFrame:
    return evaluate(
        model, ["MatchedDischarges", "BenchmarkCoverage", "ObservedMatchedLOS", "ExpectedMatchedLOS"]
    )


def scenario_cards(model: DataFrame, rate: Column | None = None) -> DataFrame:
    names = ["SelectedReduction", "ObservedMatchedDays", "ScenarioBedDays", "ScenarioRemainingDays"]
    return evaluate(model, names, rate=rate)


def discharges_by_condition(model: DataFrame) -> DataFrame:
    counts = evaluate(model, ["Discharges"], ["Condition"])
    return counts.orderBy(F.desc("Discharges"), "Condition")


def discharges_by_band(model: DataFrame) -> DataFrame:
    """All bands in band order, with zero for a band without records."""
    counts = evaluate(model, ["Discharges"], ["StayBand"])
    bands = ordered_labels(model.sparkSession, STAY_BANDS, "StayBand", "BandSort")
    return (
        bands.join(counts, "StayBand", "left")
        .select("StayBand", "BandSort", F.coalesce("Discharges", F.lit(0)).alias("Discharges"))
        .orderBy("BandSort")
    )


def stay_by_severity(model: DataFrame) -> DataFrame:
    return evaluate(model, ["AvgLOS"], ["SeverityKey", "Severity"]).orderBy("SeverityKey")


def cost_pareto(model: DataFrame, partition: Sequence[str] = ()) -> DataFrame:
    """Hospitals by cost with rank, running cost and share, and the tooltip measures."""
    by = list(partition)
    ranked = pareto(model, "HospitalName", "CostCents", by)
    tips = evaluate(model, ["Discharges", "AvgEstimatedCost"], [*by, "HospitalName"])
    dollars = {"EstimatedCost": "CostCents", "CumulativeEstimatedCost": "cumulative"}
    keys = [*by, "HospitalName"]
    tips = tips.withColumnsRenamed({name: f"_t_{name}" for name in keys})
    same = [F.col(name).eqNullSafe(F.col(f"_t_{name}")) for name in keys]
    return ranked.join(tips, same).select(
        *by,
        "HospitalName",
        *[(F.col(c).cast("double") / 100).alias(name) for name, c in dollars.items()],
        F.col("rank").alias("HospitalCostRank"),
        F.col("share").alias("CumulativeCostPct"),
        "Discharges",
        "AvgEstimatedCost",
    )


def cost_and_index(model: DataFrame) -> DataFrame:
    """One row per hospital: cost against index, with size and tooltips."""
    names = [
        "EligibleAvgCost",
        "LOSIndex",
        "MatchedDischarges",
        "BenchmarkCoverage",
        "ObservedMatchedLOS",
        "ExpectedMatchedLOS",
    ]
    return evaluate(model, names, ["HospitalName", "HospitalCounty"])


def variance_by_severity(model: DataFrame) -> DataFrame:
    """Signed variance per severity and in total (``level`` 1)."""
    names = ["LOSVarianceDays", "MatchedDischarges", "ObservedMatchedDays", "ExpectedMatchedDays"]
    return evaluate(model, names, ["Severity"], mode="rollup")


def stay_profile(model: DataFrame) -> DataFrame:
    names = [
        "ObservedMatchedLOS",
        "ExpectedMatchedLOS",
        "MatchedDischarges",
        "BenchmarkCoverage",
        "LOSIndex",
    ]
    return evaluate(model, names, ["Condition", "SeverityKey", "Severity"])


def hospital_matrix(model: DataFrame) -> DataFrame:
    """One row per hospital and a grand total computed from its own sums (``level`` 1)."""
    names = ["Discharges", "MatchedDischarges", "BenchmarkCoverage", "LOSIndex", "AvgEstimatedCost"]
    return evaluate(model, names, ["HospitalName"], mode="rollup")


def bridge(model: DataFrame, rate: Column | None = None) -> DataFrame:
    """Observed days, signed reduction and remaining days, in step order."""
    days = evaluate(model, ["ObservedMatchedDays"])
    return scenario_bridge(days, selected_rate() if rate is None else rate).orderBy("StepSort")


def rate_table(model: DataFrame) -> DataFrame:
    """Scenario days at every rate."""
    return scenario_days(evaluate(model, ["ObservedMatchedDays"]))


def decomposition(model: DataFrame, any_order: bool = False) -> DataFrame:
    """Scenario days along the fixed path, or for every choice of explain-by columns."""
    mode = "cube" if any_order else "rollup"
    return evaluate(model, ["ScenarioBedDays"], DECOMPOSITION, mode=mode)


def county_ribbon(model: DataFrame) -> DataFrame:
    """Contribution and rank of every county within a severity."""
    names = [
        "ScenarioBedDays",
        "MatchedDischarges",
        "ObservedMatchedDays",
        "SelectedReduction",
        "AvgEstimatedCost",
    ]
    sums = evaluate(model, names, ["SeverityKey", "Severity", "HospitalCounty"])
    # One row per county in each window.
    place = Window.partitionBy("SeverityKey", "Severity").orderBy(F.desc("ScenarioBedDays"))
    return sums.withColumn("CountyRank", F.rank().over(place))


def scenario_by_condition(model: DataFrame) -> DataFrame:
    return evaluate(model, ["ScenarioBedDays"], ["Condition"])
