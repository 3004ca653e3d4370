"""The registered queries: name -> function of a session and a folder of the supply-chain tables.

Sums of floating values differ between engines in the last bits, so results that rest on them are rounded:
sums to four decimals, ratios to six.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.text import half_even_cents, to_cents, trim_all
from peerbench.operators import benchmark as bm
from peerbench.operators.digests import compare_tables
from peerbench.operators.ordering import every_kth
from peerbench.operators.profile import blank_counts, group_counts, repeated_rows
from peerbench.operators.scenario import BRIDGE_STEPS, selected_rate
from peerbench.operators.selections import by_selection, selection_metrics
from peerbench.operators.sketches import distinct_counts, distinct_sketches, within_error
from peerbench.operators.star import Star
from peerbench.operators.upkeep import Rules, Version, first_version, next_version
from peerbench.plans import analysis, checks, extract, reports
from peerbench.plans.clean import benchmark_table, model_records
from peerbench.plans.lake import Lake, supply_lake
from peerbench.plans.layout import ENTITY, STRATA
from peerbench.plans.measures import MEASURES, cost_medians, displayed, distinct_levels, evaluate
from peerbench.session import sized, stored, task_count
from peerbench.sources.tables import overwrite_partitions, save_bucketed, unique_name

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

SUMS = ("MatchedExpectedDays", "ExpectedMatchedDays", "LOSVarianceDays", "ScenarioBedDays")
RATIOS = (
    "AvgExactLOS",
    "AvgLOS",
    "AvgEstimatedCost",
    "EligibleAvgCost",
    "BenchmarkCoverage",
    "CensoredShare",
    "CumulativeCostPct",
    "DischargesShare",
    "ExactDaysShare",
    "CostShare",
    "ExpectedMatchedLOS",
    "ObservedMatchedLOS",
    "LOSIndex",
    "SensitivityLOSIndex",
    "PrimaryLOSIndex",
    "LargestMovement",
    "MeanMovement",
)
DAYS = (
    "ScenarioRemainingDays",
    "ScenarioBridgeValue",
    "ScenarioBedDays_0pct",
    "ScenarioBedDays_5pct",
    "ScenarioBedDays_10pct",
)


def settled(df: DataFrame) -> DataFrame:
    """Round the columns that rest on floating sums or ratios."""
    digits = {**dict.fromkeys(SUMS, 4), **dict.fromkeys(RATIOS, 6), **dict.fromkeys(DAYS, 4)}
    return df.select(
        *[
            F.round(c, digits[c]).alias(c) if c in digits and kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settled(build(supply_lake(spark, sf_dir)))

    REGISTRY[build.__name__] = run
    return build


# --- records -----------------------------------------------------------------------------------------


@query
def clean_stays(lake: Lake) -> DataFrame:
    return lake.clean


@query
def row_key(lake: Lake) -> DataFrame:
    return lake.clean.select("DischargeKey", "SourceRowId")


@query
def first_rows(lake: Lake) -> DataFrame:
    return extract.first_rows(lake.model)


@query
def half_even_costs(lake: Lake) -> DataFrame:
    cents = half_even_cents(F.col("total_costs"))
    return lake.raw.groupBy(F.col("apr_drg_code").alias("ConditionKey")).agg(
        F.sum(cents).alias("CostCents")
    )


@query
def money_texts(lake: Lake) -> DataFrame:
    """Truncated and half-even cents of money texts with four decimals, made from whole ten-thousandths."""
    line = lake.spark.read.parquet(f"{lake.folder}/lineitem.parquet")
    units = F.round(F.col("l_extendedprice") * 100).cast("bigint") * (
        100 + F.round(F.col("l_tax") * 100).cast("bigint")
    )
    text = F.concat_ws(
        ".", F.call_function("div", units, F.lit(10000)).cast("string"), F.lpad((units % 10000).cast("string"), 4, "0")
    )
    return line.groupBy(F.col("l_returnflag").alias("PrimaryPayer")).agg(
        F.sum(to_cents(text)).alias("TruncatedCents"), F.sum(half_even_cents(text)).alias("HalfEvenCents")
    )


@query
def stay_bands(lake: Lake) -> DataFrame:
    return reports.discharges_by_band(lake.model)


@query
def stay_model(lake: Lake) -> DataFrame:
    return lake.model


# --- peer benchmark ----------------------------------------------------------------------------------


@query
def entity_stratum(lake: Lake) -> DataFrame:
    return bm.entity_strata(lake.records.filter(lake.domain.comparable()), ENTITY, STRATA, "ExactLOS")


@query
def cohort_stratum(lake: Lake) -> DataFrame:
    return bm.stratum_totals(entity_stratum(lake), STRATA)


@query
def leave_one_out(lake: Lake) -> DataFrame:
    return benchmark_table(lake.records, lake.domain)


@query
def leave_one_out_350(lake: Lake) -> DataFrame:
    return benchmark_table(lake.records, lake.domain, min_peers=350)


@query
def leave_one_out_direct(lake: Lake) -> DataFrame:
    records = lake.records.filter(lake.domain.comparable())
    return bm.leave_one_out_from_records(records, ENTITY, STRATA, "ExactLOS")


@query
def entity_summary(lake: Lake) -> DataFrame:
    return lake.summary()


@query
def condition_summary(lake: Lake) -> DataFrame:
    by = ["HospitalKey", "ConditionKey", "SeverityKey"]
    return bm.entity_summary(lake.model, by, min_matched=100)


UPKEEP = Rules(ENTITY, STRATA, "ExactLOS")


def benchmark_versions(lake: Lake) -> tuple[Version, Version]:
    """A benchmark without late promotional stays, and one with them but without line 7 of economy stays."""
    records = lake.records.filter(lake.domain.comparable())
    late = (F.col("ConditionKey") == "PROMO") & (F.col("DischargeYear") >= 1996)
    line = F.split("SourceRowId", "-")[3]
    out = (F.col("ConditionKey") == "ECONOMY") & (line == "7")
    first = first_version(records.where(~late), UPKEEP)
    return first, next_version(first, records.where(late), records.where(out), UPKEEP)


@query
def benchmark_upkeep(lake: Lake) -> DataFrame:
    """The second version, with a mark on the strata that it changed."""
    _, second = benchmark_versions(lake)
    touched = second.touched.withColumn("touched", F.lit(True))
    return second.benchmark.join(touched, list(STRATA), "left").withColumn("touched", F.coalesce("touched", F.lit(False)))


@query
def benchmark_version_sizes(lake: Lake) -> DataFrame:
    """Rows, supported rows and changed strata of both versions; the first stays as it was."""
    parts = [
        v.benchmark.agg(
            F.lit(v.number).alias("version"),
            F.count(F.lit(1)).alias("rows"),
            F.count("expected").alias("supported"),
            F.sum("own_n").alias("records"),
        ).withColumn("touched_strata", v.touched.agg(F.count(F.lit(1))).scalar())
        for v in benchmark_versions(lake)
    ]
    return parts[0].unionByName(parts[1])


# --- analysis ----------------------------------------------------------------------------------------


@query
def q1_condition(lake: Lake) -> DataFrame:
    return analysis.by_condition(lake)


@query
def q2_supported_entities(lake: Lake) -> DataFrame:
    return analysis.supported_entities(lake)


@query
def q3_severity(lake: Lake) -> DataFrame:
    return analysis.by_severity(lake)


@query
def q4_median_rank(lake: Lake) -> DataFrame:
    return analysis.median_cost(lake, ranked=True)


@query
def q4_median_narrowed(lake: Lake) -> DataFrame:
    return analysis.median_cost(lake)


@query
def q5_disposition(lake: Lake) -> DataFrame:
    return analysis.by_disposition(lake)


@query
def q6_sensitivity(lake: Lake) -> DataFrame:
    return analysis.sensitivity_index(lake)


@query
def q6_sensitivity_70(lake: Lake) -> DataFrame:
    return analysis.sensitivity_index(lake, min_peers=70)


@query
def q6_movement(lake: Lake) -> DataFrame:
    return bm.movement(analysis.sensitivity_index(lake))


@query
def share_by_condition(lake: Lake) -> DataFrame:
    amounts = {"Discharges": "*", "ExactDays": "ExactLOS", "Cost": "CostCents"}
    return bm.group_shares(lake.model, ["ConditionKey"], amounts)


# --- star schema -------------------------------------------------------------------------------------


@query
def dim_entities(lake: Lake) -> DataFrame:
    return lake.dimensions["Hospitals"].orderBy("HospitalKey")


@query
def dim_conditions(lake: Lake) -> DataFrame:
    return lake.dimensions["Conditions"].orderBy("ConditionKey")


@query
def dim_severity(lake: Lake) -> DataFrame:
    return lake.dimensions["Severity"].orderBy("SeverityKey")


@query
def dim_payers(lake: Lake) -> DataFrame:
    return lake.dimensions["Payers"].orderBy("PrimaryPayer")


@query
def star_filtered(lake: Lake) -> DataFrame:
    """Dimension filters flow to the fact, dimension labels come back."""
    star = lake.star().select({"HospitalCounty": ["EUROPE", "ASIA"], "Condition": ["Economy", "Small"]})
    labelled = star.label(["Condition", "BandSort", "AgeSort"])
    cents = (F.col("EstimatedCost") * 100).cast("bigint")
    return labelled.groupBy("Condition", "BandSort", "AgeSort").agg(
        F.count(F.lit(1)).alias("Discharges"), F.sum(cents).alias("CostCents")
    )


@query
def fact_export(lake: Lake) -> DataFrame:
    return extract.fact_export(lake)


# --- profiles ----------------------------------------------------------------------------------------


@query
def repeated_visible_rows(lake: Lake) -> DataFrame:
    return repeated_rows(lake.raw, ["source_row_id"])


@query
def repeated_categories(lake: Lake) -> DataFrame:
    """Repeats when identifiers, money, brand and stay are left out: many copies per combination."""
    unseen = ["source_row_id", "total_costs", "total_charges", "length_of_stay", "apr_risk_of_mortality"]
    return repeated_rows(lake.raw, unseen)


@query
def blank_fields(lake: Lake) -> DataFrame:
    return blank_counts(lake.raw)


def _padded(lake: Lake) -> DataFrame:
    """The raw extract with blanks and surrounding whitespace, told by the line in its ids."""
    line = F.split("source_row_id", "-")[3]
    area = F.col("health_service_area")
    return trim_all(
        lake.raw.withColumns(
            {
                "health_service_area": F.when(line == "2", F.concat(F.lit("\u00a0\t"), area, F.lit(" \u2003\n")))
                .when(line == "3", F.lit(" \u3000"))
                .when(line == "4", F.lit(None).cast("string"))
                .otherwise(area),
                "patient_disposition": F.when(line == "5", "\x1f").otherwise(F.col("patient_disposition")),
            }
        )
    )


@query
def blank_fields_padded(lake: Lake) -> DataFrame:
    return blank_counts(_padded(lake))


@query
def profile_area_padded(lake: Lake) -> DataFrame:
    return group_counts(_padded(lake), ["health_service_area"])


@query
def profile_area(lake: Lake) -> DataFrame:
    return group_counts(lake.raw, ["health_service_area"])


@query
def profile_condition(lake: Lake) -> DataFrame:
    scope = lake.raw.filter(lake.domain.scope())
    return group_counts(scope, ["apr_drg_code", "apr_drg_description"])


@query
def scope_count(lake: Lake) -> DataFrame:
    return lake.raw.filter(lake.domain.scope()).agg(F.count(F.lit(1)).alias("n"))


@query
def cohort_summary(lake: Lake) -> DataFrame:
    summary = extract.cohort_document(lake)
    digits = {
        "avg_exact_los": 6,
        "avg_estimated_cost": 6,
        "benchmark_coverage": 6,
        "matched_expected_days": 4,
        "los_index": 6,
        "five_percent_scenario_bed_days": 4,
    }
    return summary.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in summary.columns]
    )


@query
def selection_results(lake: Lake) -> DataFrame:
    return selection_metrics(lake.model, lake.domain.predicates(), ENTITY)


def _with_order(lake: Lake) -> DataFrame:
    """The labelled model with the order of each line, of which there are many per group."""
    return lake.labelled.withColumn("OrderId", F.split("SourceRowId", "-")[0])


@query
def hospitals_sketched(lake: Lake) -> DataFrame:
    """Exact distinct counts of a cube, and whether the merged sketches of its finest groups are within their error."""
    by = ["Condition", "SeverityKey"]
    rows = _with_order(lake)
    names = {"Hospitals": F.col("HospitalKey"), "Orders": F.col("OrderId")}
    sketches = stored(distinct_sketches(rows, by, names), "sketches")
    estimates = distinct_counts(sketches, by, list(names), "cube").withColumnsRenamed({n: f"_{n}" for n in names})
    exact = distinct_levels(rows, by, names, "cube")
    return _compared(exact, estimates, [*by, "level"], list(names))


def _compared(exact: DataFrame, estimates: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    within = [within_error(F.col(f"_{n}"), F.col(n)).alias(f"{n}Within") for n in names]
    return exact.alias("l").join(estimates.alias("r"), on, "left").select(*[f"l.{k}" for k in keys], *names, *within)


@query
def selections_sketched(lake: Lake) -> DataFrame:
    """The same for the named selections: sketches per combination of selections, merged per selection."""
    selections = lake.domain.predicates()
    flags = {label: f"_in{i}" for i, label in enumerate(selections)}
    rows = _with_order(lake).withColumns({flags[s]: F.coalesce(p, F.lit(False)) for s, p in selections.items()})
    names = {"Hospitals": F.col("HospitalKey"), "Orders": F.col("OrderId")}
    sketches = stored(distinct_sketches(rows, list(flags.values()), names), "sketches")
    estimates = distinct_counts(by_selection(sketches, flags), ["Selection"], list(names))
    exact = by_selection(rows, flags).groupBy("Selection").agg(*[F.count_distinct(c).alias(n) for n, c in names.items()])
    return _compared(exact, estimates.withColumnsRenamed({n: f"_{n}" for n in names}), ["Selection"], list(names))


@query
def measures_approximate(lake: Lake) -> DataFrame:
    """A rollup whose hospitals are estimated: within the error of the exact ones, all other measures equal."""
    by = ["Condition", "SeverityKey"]
    names = ["Discharges", "Hospitals", "AvgLOS"]
    estimated = evaluate(lake.labelled, names, by, mode="rollup", approximate=True)
    exact = evaluate(lake.labelled, ["Hospitals"], by, mode="rollup")
    kept = estimated.withColumnRenamed("Hospitals", "_Hospitals")
    on = F.lit(True)
    for key in [*by, "level"]:
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    within = within_error(F.col("_Hospitals"), F.col("Hospitals")).alias("HospitalsWithin")
    return kept.alias("l").join(exact.alias("r"), on).select(
        *[f"l.{key}" for key in [*by, "level"]], "Discharges", "AvgLOS", "Hospitals", within
    )


@query
def medians_seeded(lake: Lake) -> DataFrame:
    """Middle costs of a cube, found with sketches of its finest groups."""
    by = ["Condition", "HospitalCounty"]
    return cost_medians(lake.labelled, by, "cube").withColumn("level", F.col("level").cast("bigint"))


# --- measures ----------------------------------------------------------------------------------------

PLAIN = (
    "Discharges",
    "Hospitals",
    "ExactLOSDischarges",
    "AvgLOS",
    "MedianLOS",
    "CensoredStays",
    "CensoredShare",
    "EstimatedCost",
    "AvgEstimatedCost",
    "MedianEstimatedCost",
    "Charges",
    "MatchedDischarges",
    "BenchmarkCoverage",
    "ObservedMatchedDays",
    "ExpectedMatchedDays",
    "ObservedMatchedLOS",
    "ExpectedMatchedLOS",
    "LOSIndex",
    "PeerReference",
    "SelectedReduction",
    "ScenarioBedDays",
    "ScenarioRemainingDays",
    "EligibleAvgCost",
    "LOSVarianceDays",
)


@query
def measures_global(lake: Lake) -> DataFrame:
    return evaluate(lake.labelled, PLAIN)


@query
def measures_by_condition(lake: Lake) -> DataFrame:
    return evaluate(lake.labelled, PLAIN, ["Condition"])


@query
def measures_filtered(lake: Lake) -> DataFrame:
    """Two slicers, one chosen rate, small groups: suppression and blanks appear."""
    selection = {"HospitalCounty": ["EUROPE", "AFRICA"], "AgeGroup": ["HOUSEHOLD", "MACHINERY"]}
    rate = selected_rate(lambda r: r == 0.1)
    return evaluate(lake.labelled, PLAIN, ["HospitalName", "SeverityKey"], selection, rate)


@query
def measures_ranked(lake: Lake) -> DataFrame:
    """Ranks and running costs of the hospitals within each named selection."""
    return evaluate(_by_selection(lake), RANKS, ["Selection", "HospitalName"])


@query
def measures_ranked_cube(lake: Lake) -> DataFrame:
    return evaluate(lake.labelled, RANKS, ["Condition", "HospitalName"], mode="cube")


@query
def measures_all(lake: Lake) -> DataFrame:
    """All 28 measures of the seven named selections in one call."""
    remaining = F.lit(BRIDGE_STEPS[-1])
    return evaluate(_by_selection(lake), list(MEASURES), ["Selection"], step=remaining)


def _by_selection(lake: Lake) -> DataFrame:
    flagged = lake.labelled.withColumns({f"_in{i}": p for i, p in enumerate(lake.domain.predicates().values())})
    return by_selection(flagged, {label: f"_in{i}" for i, label in enumerate(lake.domain.selections)})


RANKS = ["EstimatedCost", "HospitalCostRank", "CumulativeEstimatedCost", "CumulativeCostPct"]


@query
def measures_rollup(lake: Lake) -> DataFrame:
    return evaluate(lake.labelled, PLAIN, ["Condition", "SeverityKey"], mode="rollup")


@query
def measures_cube(lake: Lake) -> DataFrame:
    return evaluate(lake.labelled, PLAIN, ["Condition", "HospitalCounty"], mode="cube")


@query
def measures_displayed(lake: Lake) -> DataFrame:
    """Measures as display text in their catalogue formats."""
    names = [
        "Discharges",
        "AvgLOS",
        "CensoredShare",
        "EstimatedCost",
        "BenchmarkCoverage",
        "ExpectedMatchedDays",
        "LOSIndex",
        "SelectedReduction",
        "LOSVarianceDays",
    ]
    return displayed(evaluate(lake.labelled, names, ["Condition"]))


@query
def sql_views(lake: Lake) -> DataFrame:
    """Spark SQL over the registered views."""
    lake.views()
    return lake.spark.sql(
        """
        SELECT s.HospitalCounty, count(*) AS Hospitals, sum(s.Discharges) AS Discharges,
               sum(b.strata) AS Strata, sum(b.supported) AS Supported
        FROM hospital_summary s
        JOIN (SELECT HospitalKey, count(*) AS strata, count(ExpectedLOS) AS supported
              FROM benchmark JOIN cohort_stratum USING (ConditionKey, SeverityKey, AgeGroup)
              WHERE CohortN - PeerN > 0 GROUP BY HospitalKey) b USING (HospitalKey)
        GROUP BY s.HospitalCounty
        """
    )


@query
def pareto(lake: Lake) -> DataFrame:
    return reports.cost_pareto(lake.labelled)


@query
def pareto_by_condition(lake: Lake) -> DataFrame:
    return reports.cost_pareto(lake.labelled, ["Condition"])


@query
def scenario_rates(lake: Lake) -> DataFrame:
    return reports.rate_table(lake.labelled)


@query
def scenario_bridge(lake: Lake) -> DataFrame:
    return reports.bridge(lake.labelled)


@query
def variance_waterfall(lake: Lake) -> DataFrame:
    return reports.variance_by_severity(lake.labelled)


@query
def entity_matrix(lake: Lake) -> DataFrame:
    return reports.hospital_matrix(lake.labelled)


@query
def decomposition_path(lake: Lake) -> DataFrame:
    return reports.decomposition(lake.labelled)


@query
def decomposition_any(lake: Lake) -> DataFrame:
    return reports.decomposition(lake.labelled, any_order=True)


@query
def ribbon(lake: Lake) -> DataFrame:
    return reports.county_ribbon(lake.labelled)


@query
def scatter(lake: Lake) -> DataFrame:
    return reports.cost_and_index(lake.labelled)


@query
def los_profile(lake: Lake) -> DataFrame:
    return reports.stay_profile(lake.labelled)


@query
def kpi_page1(lake: Lake) -> DataFrame:
    return reports.activity_cards(lake.labelled)


@query
def kpi_page2(lake: Lake) -> DataFrame:
    return reports.comparison_cards(lake.labelled)


@query
def kpi_page3(lake: Lake) -> DataFrame:
    return reports.scenario_cards(lake.labelled)


@query
def los_by_severity(lake: Lake) -> DataFrame:
    return reports.stay_by_severity(lake.labelled)


@query
def by_condition(lake: Lake) -> DataFrame:
    return reports.discharges_by_condition(lake.labelled)


@query
def scenario_by_condition(lake: Lake) -> DataFrame:
    return reports.scenario_by_condition(lake.labelled)


# --- sampling, files and checks ----------------------------------------------------------------------


@query
def systematic_sample(lake: Lake) -> DataFrame:
    strata = lake.benchmark.select(ENTITY, *STRATA)
    return every_kth(strata, [F.col(c) for c in (ENTITY, *STRATA)])


@query
def page_union(lake: Lake) -> DataFrame:
    return extract.page_union(lake)


@query
def page_read(lake: Lake) -> DataFrame:
    return extract.read_pages(lake)


@query
def rescued_rows(lake: Lake) -> DataFrame:
    return extract.rescued_rows(lake)


@query
def marked_pages(lake: Lake) -> DataFrame:
    return extract.marked_pages(lake)


@query
def profile_documents(lake: Lake) -> DataFrame:
    return extract.profile_documents(lake)


@query
def result_files(lake: Lake) -> DataFrame:
    return extract.result_files(lake)


@query
def replaced_table(lake: Lake) -> DataFrame:
    return extract.replaced_table(lake)


BUCKETED = [ENTITY, *STRATA]


@query
def bucketed_model(lake: Lake) -> DataFrame:
    """The model from two tables in the same buckets, joined without a shuffle."""
    buckets = task_count(lake.spark, lake.rows)
    records = save_bucketed(lake.clean, unique_name("records"), BUCKETED, buckets)
    bench = save_bucketed(lake.benchmark, unique_name("benchmark"), BUCKETED, buckets)
    return model_records(records, bench)


@query
def bucketed_strata(lake: Lake) -> DataFrame:
    """Sums per hospital and stratum of a bucketed table partitioned by year, without a shuffle."""
    buckets = task_count(lake.spark, lake.rows)
    records = save_bucketed(lake.clean, unique_name("records"), BUCKETED, buckets, ["DischargeYear"])
    return bm.entity_strata(records.filter(lake.domain.comparable()), ENTITY, STRATA, "ExactLOS")


@query
def year_overwrite(lake: Lake) -> DataFrame:
    """One year of a saved table written anew, with a cent more per record and without line 1; the others stay."""
    name = unique_name("records")
    records = save_bucketed(lake.clean, name, BUCKETED, task_count(lake.spark, lake.rows), ["DischargeYear"])
    line = F.split("SourceRowId", "-")[3]
    year = stored(records.where((F.col("DischargeYear") == 1995) & (line != "1")), "year")
    overwrite_partitions(year.withColumn("CostCents", F.col("CostCents") + 1), name)
    return lake.spark.table(name).groupBy("DischargeYear").agg(
        F.count(F.lit(1)).alias("Discharges"), F.sum("CostCents").alias("CostCents")
    )


@query
def star_pruned(lake: Lake) -> DataFrame:
    """Slicers over the stored fact: only the folders of the chosen conditions and years are read."""
    star = lake.stored_star().select({"HospitalCounty": ["EUROPE", "ASIA"], "Condition": ["Economy", "Small"]})
    labelled = Star(star.fact.where(F.col("DischargeYear").isin(1994, 1995)), star.dims).label(["Condition", "BandSort"])
    cents = (F.col("EstimatedCost") * 100).cast("bigint")
    return labelled.groupBy("Condition", "DischargeYear", "BandSort").agg(
        F.count(F.lit(1)).alias("Discharges"), F.sum(cents).alias("CostCents")
    )


@query
def csv_roundtrip(lake: Lake) -> DataFrame:
    return extract.csv_roundtrip(lake)


@query
def export_roundtrip(lake: Lake) -> DataFrame:
    return extract.export_roundtrip(lake)


@query
def expected_compare(lake: Lake) -> DataFrame:
    compared = extract.expected_compare(lake)
    return compared.select("Selection", "metric", F.round("expected", 4).alias("expected"), "passed")


@query
def checks_damaged(lake: Lake) -> DataFrame:
    return checks.damaged_checks(lake)


@query
def checks_damaged_model(lake: Lake) -> DataFrame:
    return checks.damaged_model_checks(lake)


@query
def layer_figures(lake: Lake) -> DataFrame:
    return checks.layer_figures(lake)


@query
def manifest_rows(lake: Lake) -> DataFrame:
    return checks.manifest_rows(lake)


@query
def contract_damaged(lake: Lake) -> DataFrame:
    return checks.contract_damaged(lake)


@query
def peer_reconciliation_damaged(lake: Lake) -> DataFrame:
    return checks.peer_reconciliation_damaged(lake)


@query
def contract_check(lake: Lake) -> DataFrame:
    return checks.contract_check(lake)


@query
def peer_reconciliation(lake: Lake) -> DataFrame:
    return checks.peer_reconciliation(lake)


def _independent_model(lake: Lake) -> DataFrame:
    """The model again, with stratum totals taken from the records and not from the hospitals' parts."""
    again = bm.leave_one_out_from_records(lake.records.filter(lake.domain.comparable()), ENTITY, STRATA, "ExactLOS")
    return model_records(lake.clean, again).select(*lake.model.columns)


def _defective_model(lake: Lake) -> DataFrame:
    """The model with a wrong cost, a lost record and a repeated one here and there."""
    key, cost = F.col("DischargeKey"), F.col("CostCents")
    changed = lake.model.where(key % 2003 != 0).withColumn("CostCents", F.when(key % 1009 == 0, cost + 1).otherwise(cost))
    return changed.unionAll(changed.where(key % 4001 == 0))


@query
def digest_equal(lake: Lake) -> DataFrame:
    """Two models made in different ways: equal digests, so no row is compared."""
    again = _independent_model(lake)
    with sized(lake.spark, lake.rows):
        again = stored(again, "model-again")
    compared = compare_tables(lake.model, again, "DischargeKey")
    sizes = [t.agg(F.sum("rows").cast("bigint")).scalar() for t in (compared.left_leaves, compared.right_leaves)]
    return compared.ranges().agg(F.count(F.lit(1)).alias("differing_ranges")).select(
        sizes[0].alias("left_rows"), sizes[1].alias("right_rows"), "differing_ranges"
    )


@query
def digest_ranges(lake: Lake) -> DataFrame:
    return compare_tables(lake.model, _defective_model(lake), "DischargeKey").ranges()


@query
def digest_rows(lake: Lake) -> DataFrame:
    """The differing rows themselves, from the differing ranges only."""
    compared = compare_tables(lake.model, _defective_model(lake), "DischargeKey")
    return compared.rows().select("DischargeKey", "HospitalKey", "CostCents", "side")


@query
def peer_spot_check(lake: Lake) -> DataFrame:
    return checks.peer_spot_check(lake)


def _all_checks(lake: Lake) -> DataFrame:
    return checks.checks(lake)


_all_checks.__name__ = "checks"
query(_all_checks)


def _manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.manifest_check(supply_lake(spark, sf_dir), sf_dir)


REGISTRY["manifest_check"] = _manifest_check


def _file_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet")
    return extract.file_statuses(spark, suppliers, "s_suppkey", "s_name")


REGISTRY["file_statuses"] = _file_statuses
