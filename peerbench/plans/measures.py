"""The measure catalogue and its evaluation under any filter, grouping and scenario.

A measure is an expression over a few base aggregates.  ``evaluate`` computes only the bases that the asked
measures need: in one aggregation for plain groups, and for subtotals from the finest groups upwards, so the
records are read once and never expanded per subtotal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.numbers import blank_minus, display, ratio
from peerbench.operators.pareto import pareto
from peerbench.operators.scenario import BRIDGE_STEPS, selected_rate
from peerbench.operators.sketches import REGISTERS, seeded_median
from peerbench.session import sized, stored, task_count

# Display threshold of the index measures: matched records needed in the current selection.
MIN_MATCHED = 30

# Base aggregates that add up over groups: name -> aggregate over records.
ADDITIVE = {
    "n": lambda: F.count(F.lit(1)),
    "exact_n": lambda: F.count("ExactLOS"),
    "exact_days": lambda: F.sum("ExactLOS"),
    "censored": lambda: F.sum("LOSCensored"),
    "cost": lambda: F.sum("CostCents"),
    "cost_n": lambda: F.count("CostCents"),
    "charges": lambda: F.sum("ChargesCents"),
    "matched": lambda: F.sum("BenchmarkEligible"),
    "observed": lambda: F.sum(F.when(F.col("BenchmarkEligible") == 1, F.col("ExactLOS"))),
    "expected": lambda: F.sum("ExpectedLOS"),
}
# Base aggregates that need the values themselves.
HOSPITALS, STAY_MEDIAN, COST_MEDIAN = "hospitals", "stay_median", "cost_median"
# Bases that compare the hospitals of a group with each other.
COST_RANK, RUNNING_COST, RUNNING_SHARE = "cost_rank", "running_cost", "running_share"
RANKED = "HospitalName"


@dataclass(frozen=True)
class Measure:
    """Display name, bases it needs, expression over them and the rate, format and folder."""

    title: str
    needs: tuple[str, ...]
    value: Callable[[dict[str, Column]], Column]
    style: str
    folder: str
    meaning: str


def _shown(b: dict[str, Column], value: Column) -> Column:
    return F.when(b["matched"] >= MIN_MATCHED, value)


def _reduced(b: dict[str, Column]) -> Column:
    return b["observed"] * b["rate"]


# Titles, formats and folders of the catalogue, in its order.
MEASURES = {
    "Discharges": Measure(
        "Discharges", ("n",), lambda b: b["n"], "#,##0", "Overview", "Records, not distinct persons."
    ),
    "Hospitals": Measure(
        "Hospitals", (HOSPITALS,), lambda b: b[HOSPITALS], "#,##0", "Overview", "Hospitals with records."
    ),
    "ExactLOSDischarges": Measure(
        "Exact LOS Discharges",
        ("exact_n",),
        lambda b: b["exact_n"],
        "#,##0",
        "Data quality",
        "Records with a known stay.",
    ),
    "AvgLOS": Measure(
        "Avg LOS (under 120 days)",
        ("exact_days", "exact_n"),
        lambda b: ratio(b["exact_days"], b["exact_n"]),
        "0.00",
        "Overview",
        "Mean known stay; capped stays are left out.",
    ),
    "MedianLOS": Measure(
        "Median LOS (under 120 days)",
        (STAY_MEDIAN,),
        lambda b: b[STAY_MEDIAN],
        "0.0",
        "Overview",
        "Median known stay; capped stays are left out.",
    ),
    "CensoredStays": Measure(
        "Censored Stays",
        ("censored",),
        lambda b: b["censored"],
        "#,##0",
        "Data quality",
        "Stays that the source reports only as capped.",
    ),
    "CensoredShare": Measure(
        "Censored Share",
        ("censored", "n"),
        lambda b: ratio(b["censored"], b["n"]),
        "0.00%",
        "Data quality",
        "Capped stays over all records.",
    ),
    "EstimatedCost": Measure(
        "Estimated Cost",
        ("cost",),
        lambda b: b["cost"].cast("double") / 100,
        "$#,##0",
        "Cost",
        "Sum of estimated cost in dollars.",
    ),
    "AvgEstimatedCost": Measure(
        "Avg Estimated Cost",
        ("cost", "cost_n"),
        lambda b: ratio(b["cost"], b["cost_n"]) / 100,
        "$#,##0",
        "Cost",
        "Mean estimated cost per record.",
    ),
    "MedianEstimatedCost": Measure(
        "Median Estimated Cost",
        (COST_MEDIAN,),
        lambda b: b[COST_MEDIAN].cast("double") / 200,
        "$#,##0",
        "Cost",
        "Median estimated cost; capped stays count.",
    ),
    "Charges": Measure(
        "Charges",
        ("charges",),
        lambda b: b["charges"].cast("double") / 100,
        "$#,##0",
        "Cost",
        "Billed charges.",
    ),
    "MatchedDischarges": Measure(
        "Matched Discharges",
        ("matched",),
        lambda b: b["matched"],
        "#,##0",
        "Peer comparison",
        "Records with a known stay and enough peers.",
    ),
    "BenchmarkCoverage": Measure(
        "Benchmark Coverage",
        ("matched", "n"),
        lambda b: ratio(b["matched"], b["n"]),
        "0.00%",
        "Peer comparison",
        "Matched records over all records.",
    ),
    "ObservedMatchedDays": Measure(
        "Observed Matched Days",
        ("observed",),
        lambda b: b["observed"],
        "#,##0",
        "Peer comparison",
        "Days observed on matched records.",
    ),
    "ExpectedMatchedDays": Measure(
        "Expected Matched Days",
        ("expected",),
        lambda b: b["expected"],
        "#,##0.0",
        "Peer comparison",
        "Sum of the fixed peer expectations.",
    ),
    "ObservedMatchedLOS": Measure(
        "Observed Matched LOS",
        ("observed", "matched"),
        lambda b: ratio(b["observed"], b["matched"]),
        "0.00",
        "Peer comparison",
        "Mean observed stay of matched records.",
    ),
    "ExpectedMatchedLOS": Measure(
        "Expected Matched LOS",
        ("expected", "matched"),
        lambda b: ratio(b["expected"], b["matched"]),
        "0.00",
        "Peer comparison",
        "Mean expected stay of matched records.",
    ),
    "LOSIndex": Measure(
        "LOS Index",
        ("matched", "observed", "expected"),
        lambda b: _shown(b, ratio(b["observed"], b["expected"])),
        '0.00"x"',
        "Peer comparison",
        "Observed over expected; blank for small selections.",
    ),
    "PeerReference": Measure(
        "Peer Reference",
        ("matched",),
        lambda b: _shown(b, F.lit(1.0)),
        '0.00"x"',
        "Peer comparison",
        "Reference value of the index.",
    ),
    "SelectedReduction": Measure(
        "Selected Reduction",
        (),
        lambda b: b["rate"],
        "0.0%",
        "Scenario",
        "Chosen reduction; 5 % unless exactly one is chosen.",
    ),
    "ScenarioBedDays": Measure(
        "Scenario Bed Days",
        ("observed",),
        _reduced,
        "#,##0.0",
        "Scenario",
        "Matched days times the chosen reduction.",
    ),
    "ScenarioRemainingDays": Measure(
        "Scenario Remaining Days",
        ("observed",),
        lambda b: blank_minus(b["observed"].cast("double"), _reduced(b)),
        "#,##0.0",
        "Scenario",
        "Matched days less the reduction.",
    ),
    "EligibleAvgCost": Measure(
        "Eligible Avg Cost",
        ("matched", "cost", "cost_n"),
        lambda b: _shown(b, ratio(b["cost"], b["cost_n"]) / 100),
        "$#,##0",
        "Peer comparison",
        "Mean cost where enough records are matched.",
    ),
    "LOSVarianceDays": Measure(
        "LOS Variance Days",
        ("observed", "expected"),
        lambda b: blank_minus(b["observed"].cast("double"), b["expected"]),
        "+#,##0.0;-#,##0.0;0.0",
        "Peer comparison",
        "Observed less expected days on matched records.",
    ),
    "HospitalCostRank": Measure(
        "Hospital Cost Rank", (COST_RANK,), lambda b: b[COST_RANK], "#,##0", "Cost", "Rank of a hospital by cost."
    ),
    "CumulativeEstimatedCost": Measure(
        "Cumulative Estimated Cost",
        (RUNNING_COST,),
        lambda b: b[RUNNING_COST].cast("double") / 100,
        "$#,##0",
        "Cost",
        "Running cost from the costliest hospital.",
    ),
    "CumulativeCostPct": Measure(
        "Cumulative Cost %",
        (RUNNING_SHARE,),
        lambda b: b[RUNNING_SHARE],
        "0.0%",
        "Cost",
        "Running cost over the cost of the selection.",
    ),
    "ScenarioBridgeValue": Measure(
        "Scenario Bridge Value",
        ("observed",),
        lambda b: bridge_value(b["step"], b["observed"], b["rate"]),
        "#,##0.0",
        "Scenario",
        "Value of one bridge step.",
    ),
}


def bridge_value(step: Column, observed: Column, rate: Column) -> Column:
    """Value of the one chosen bridge step; blank for none."""
    days = observed.cast("double")
    return (
        F.when(step == BRIDGE_STEPS[0], days)
        .when(step == BRIDGE_STEPS[1], -(days * rate))
        .when(step == BRIDGE_STEPS[2], blank_minus(days, days * rate))
    )


def catalogue(spark: SparkSession) -> DataFrame:
    """Name, title, format, folder and meaning of every measure."""
    rows = [(k, m.title, m.style, m.folder, m.meaning) for k, m in MEASURES.items()]
    return spark.createDataFrame(
        rows, "name string, title string, format string, folder string, meaning string"
    )


def evaluate(
    model: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    selection: dict[str, Sequence] | Column | None = None,
    rate: Column | None = None,
    mode: str = "group",
    step: Column | None = None,
    entity: str = "HospitalKey",
    approximate: bool = False,
) -> DataFrame:
    """``by`` columns and one column per measure.

    ``selection`` narrows the records (column -> chosen values, or a predicate); their expectations stay as
    assigned.  ``rate`` is the chosen reduction and ``step`` the chosen bridge step.  With ``mode`` rollup or
    cube there are subtotal rows as well, told apart by ``level`` (the grouping id); every measure of a
    subtotal is computed from its own sums, never from the values of its parts.  With ``approximate`` hospitals are
    estimated from sketches, so they need no row per group and hospital.
    """
    rows = model
    if isinstance(selection, dict):
        for column, chosen in selection.items():
            rows = rows.filter(F.col(column).isin(list(chosen)))
    elif selection is not None:
        rows = rows.filter(selection)

    needs = list(dict.fromkeys(need for m in measures for need in MEASURES[m].needs))
    level = [] if mode == "group" else ["level"]
    if mode == "group":
        bases = _grouped(rows, by, needs, entity, approximate)
    else:
        bases = _subtotals(rows, by, needs, entity, mode, approximate)
    if COST_MEDIAN in needs:
        bases = _beside(bases, _cost_medians(rows, by, mode), [*by, *level])
    if {COST_RANK, RUNNING_COST, RUNNING_SHARE} & set(needs):
        keys = [*by, *level]
        bases = _beside(bases, _cost_ranks(rows, by, mode), keys)

    known = {need: F.col(f"_{need}" if need in ADDITIVE else need) for need in needs}
    known["rate"] = selected_rate() if rate is None else rate
    known["step"] = F.lit(None).cast("string") if step is None else step
    return bases.select(
        *by, *level, *[MEASURES[m].value(known).alias(m) for m in measures]
    )


def _beside(bases: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``bases`` with the other columns of ``more``, which has at most one row per key; NULL keys are equal."""
    added = [c for c in more.columns if c not in keys]
    if not keys:
        return bases.select("*", *[more.select(c).scalar().alias(c) for c in added])
    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"b.{key}").eqNullSafe(F.col(f"m.{key}"))
    return bases.alias("b").join(more.alias("m"), on, "left").select("b.*", *[f"m.{c}" for c in added])


def _cost_ranks(rows: DataFrame, by: Sequence[str], mode: str) -> DataFrame:
    """Rank, running cost and running share of every group among the hospitals that its other columns leave.

    A group of one hospital is ranked among the hospitals of the same other columns.  A group of several hospitals
    costs more than each of them, so it has rank 1, and the running cost is that of its costliest hospital.
    """
    keys = list(by) if mode == "group" else [*by, "level"]
    costs = rows.groupBy(*by, F.col(RANKED).alias("_hospital")).agg(
        F.sum(F.col("CostCents").cast("decimal(20,0)")).alias("_cost")
    )
    if mode != "group":
        costs = _expanded(costs, by, mode).groupBy(*keys, "_hospital").agg(F.sum("_cost").alias("_cost"))
    # One row per group and hospital; the records are not needed again.
    costs = stored(costs, "hospital-costs")
    kept = F.lit(RANKED in by)
    if RANKED in by and mode != "group":
        kept = F.col("level").bitwiseAND(F.lit(1 << (len(by) - 1 - list(by).index(RANKED)))) == 0
    groups = costs.where(~kept).groupBy(*keys).agg(F.max("_cost").alias("_top"), F.sum("_cost").alias("_all"))
    several = groups.select(
        *keys,
        F.when(F.col("_all").isNotNull(), F.lit(1)).cast("bigint").alias(COST_RANK),
        F.col("_top").alias(RUNNING_COST),
        ratio(F.col("_top"), F.col("_all")).alias(RUNNING_SHARE),
    )
    if RANKED not in by:
        return several
    others = [key for key in keys if key != RANKED]
    single = pareto(costs.where(kept).withColumnRenamed("_cost", RUNNING_COST).drop("_hospital"), RANKED, RUNNING_COST, others)
    single = single.select(
        *keys, F.col("rank").cast("bigint").alias(COST_RANK), F.col("cumulative").alias(RUNNING_COST), F.col("share").alias(RUNNING_SHARE)
    )
    return single if mode == "group" else several.unionByName(single)


def _expanded(finest: DataFrame, by: Sequence[str], mode: str) -> DataFrame:
    """One row for every subtotal that a finest group belongs to, with its ``level`` and all other columns."""
    others = [c for c in finest.columns if c not in by]
    sets = F.explode(_grouping_sets(finest, by, mode)).alias("_g")
    return finest.select(*others, sets).select(*others, "_g.*")


def _grouped(
    rows: DataFrame, by: Sequence[str], needs: Sequence[str], entity: str, approximate: bool
) -> DataFrame:
    """The bases of every group.  Hospitals and stays are counted by themselves: beside sums, every group and hospital
    would be shuffled with all sums and with the stays of its median."""
    aggregates = [ADDITIVE[need]().alias(f"_{need}") for need in needs if need in ADDITIVE]
    if approximate and HOSPITALS in needs:
        aggregates.append(F.hll_sketch_estimate(F.hll_sketch_agg(entity, REGISTERS)).alias(HOSPITALS))
    bases = rows.groupBy(*by).agg(*(aggregates or [F.count(F.lit(1)).alias("_n")]))
    if HOSPITALS in needs and not approximate:
        bases = _beside(bases, rows.groupBy(*by).agg(F.count_distinct(entity).alias(HOSPITALS)), by)
    if STAY_MEDIAN in needs:
        # At most 119 distinct stays per group.
        stays = rows.groupBy(*by, "ExactLOS").agg(F.count(F.lit(1)).alias("_rows"))
        median = F.percentile("ExactLOS", 0.5, F.col("_rows")).alias(STAY_MEDIAN)
        bases = _beside(bases, stays.groupBy(*by).agg(median), by)
    return bases


def _subtotals(
    rows: DataFrame, by: Sequence[str], needs: Sequence[str], entity: str, mode: str, approximate: bool
) -> DataFrame:
    if STAY_MEDIAN in needs:
        # By itself: its finest groups are few, and those of the other bases need not be split by stay.
        others = [need for need in needs if need != STAY_MEDIAN]
        bases = _subtotals(rows, by, others, entity, mode, approximate)
        return _beside(bases, _stay_medians(rows, by, mode), [*by, "level"])
    additive = [need for need in needs if need in ADDITIVE]
    whole = next((c for c in by if c in (RANKED, entity)), None)
    if whole and HOSPITALS not in needs:
        return _subtotals_within(rows, by, additive, mode, whole)
    detail = list(by)
    if HOSPITALS in needs and entity not in detail and not approximate:
        detail.append(entity)
    sketches = [F.hll_sketch_agg(entity, REGISTERS).alias("_sketch")] if approximate and HOSPITALS in needs else []
    finest = rows.groupBy(*detail).agg(
        F.count(F.lit(1)).alias("_rows"), *[ADDITIVE[need]().alias(f"_{need}") for need in additive], *sketches
    )
    grouped = finest.rollup(*by) if mode == "rollup" else finest.cube(*by)
    aggregates = [F.grouping_id().alias("level")]
    aggregates += [F.sum(f"_{need}").alias(f"_{need}") for need in additive]
    if HOSPITALS in needs:
        merged = F.hll_sketch_estimate(F.hll_union_agg("_sketch", F.lit(False)))
        aggregates.append((merged if approximate else F.count_distinct(entity)).alias(HOSPITALS))
    return grouped.agg(*aggregates)


def _stay_medians(rows: DataFrame, by: Sequence[str], mode: str) -> DataFrame:
    finest = rows.groupBy(*by, "ExactLOS").agg(F.count(F.lit(1)).alias("_rows"))
    grouped = finest.rollup(*by) if mode == "rollup" else finest.cube(*by)
    return grouped.agg(
        F.grouping_id().alias("level"), F.percentile("ExactLOS", 0.5, F.col("_rows")).alias(STAY_MEDIAN)
    )


def _subtotals_within(
    rows: DataFrame, by: Sequence[str], additive: Sequence[str], mode: str, whole: str
) -> DataFrame:
    """Sums of all subtotals where ``whole`` is the column of many values.

    The finest groups are shuffled once, by ``whole``: every subtotal that keeps it is then summed inside its task, and
    only sums without it, which are few, are shuffled again.
    """
    spark, others = rows.sparkSession, [c for c in by if c != whole]
    with sized(spark, rows.count()):
        finest = stored(
            rows.groupBy(*by).agg(
                F.count(F.lit(1)).alias("_rows"), *[ADDITIVE[need]().alias(f"_{need}") for need in additive]
            ),
            "finest-groups",
        )
    sums = [F.sum(c).alias(c) for c in finest.columns if c not in by]
    # The sums of one value of ``whole`` stay together, so a task has as many as there are grouping sets.
    tasks = task_count(spark, finest.count() * (len(by) if mode == "rollup" else 1 << len(others)))
    nothing = F.lit(None).cast(dict(finest.dtypes)[whole]).alias(whole)
    sides = {True: finest.repartition(tasks, whole), False: finest.groupBy(*others, nothing).agg(*sums)}
    parts = []
    for kept, side in sides.items():
        values = [c for c in side.columns if c not in others]
        sets = side.select(*values, F.explode(_grouping_sets(side, by, mode, whole, kept)).alias("_g"))
        parts.append(sets.select(*values, "_g.*").groupBy(*by, "level").agg(*sums))
    return parts[0].unionByName(parts[1])


def distinct_levels(rows: DataFrame, by: Sequence[str], counted: dict[str, Column], mode: str) -> DataFrame:
    """Exact distinct counts of all subtotals, told apart by ``level``, for every counted expression (name -> column).

    Different values per finest group are shuffled by the value, so each is told apart in one task for all subtotals.
    """
    keys, spark, size = [*by, "level"], rows.sparkSession, rows.count()
    result = None
    for name, column in counted.items():
        with sized(spark, size):
            finest = stored(rows.groupBy(*by, column.alias("_value")).agg(F.count(F.lit(1)).alias("_rows")), "distinct-values")
        sets = F.explode(_grouping_sets(finest, by, mode)).alias("_g")
        placed = finest.repartition(task_count(spark, finest.count()), "_value").select("_value", sets)
        counts = placed.select("_value", "_g.*").distinct().groupBy(*keys).agg(F.count("_value").alias(name))
        result = counts if result is None else _beside(result, counts, keys)
    return result


def cost_medians(rows: DataFrame, by: Sequence[str], mode: str = "group") -> DataFrame:
    """``by`` (and ``level`` for subtotals), ``low`` and ``high``: the middle costs in cents."""
    if mode == "group":
        return seeded_median(rows, by, "CostCents")

    return seeded_median(rows, by, "CostCents", lambda finest: _expanded(finest, by, mode), ["level", *by])


def _cost_medians(rows: DataFrame, by: Sequence[str], mode: str) -> DataFrame:
    keys = list(by) if mode == "group" else ["level", *by]
    return cost_medians(rows, by, mode).select(*keys, (F.col("low") + F.col("high")).alias(COST_MEDIAN))


def _grouping_sets(
    rows: DataFrame, by: Sequence[str], mode: str, whole: str | None = None, with_whole: bool = True
) -> Column:
    """Array with one struct per grouping set of a record: grouping id and the kept columns.

    With ``whole`` only the sets that keep this column (or, without ``with_whole``, drop it), which is not in the structs.
    """
    if mode == "rollup":
        kept_sets = [set(by[:size]) for size in range(len(by), -1, -1)]
    else:
        kept_sets = [set(c) for size in range(len(by), -1, -1) for c in combinations(by, size)]
    if whole is not None:
        kept_sets = [kept for kept in kept_sets if (whole in kept) == with_whole]
    kinds = dict(rows.dtypes)
    sets = []
    for kept in kept_sets:
        level = sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in kept)
        columns = [
            (F.col(c) if c in kept else F.lit(None).cast(kinds[c])).alias(c) for c in by if c != whole
        ]
        sets.append(F.struct(F.lit(level).cast("bigint").alias("level"), *columns))
    return F.array(*sets)


def displayed(result: DataFrame) -> DataFrame:
    """Measure columns as display text in their catalogue format."""
    return result.select(
        *[
            display(F.col(c), MEASURES[c].style).alias(c) if c in MEASURES else F.col(c)
            for c in result.columns
        ]
    )
