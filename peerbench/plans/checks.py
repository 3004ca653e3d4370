"""Data-quality checks and reconciliations as rows of check, passed, observed, expected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio, within
from peerbench.operators.benchmark import leave_one_out_from_counts
from peerbench.operators.compare import value_gaps
from peerbench.operators.figures import long_figures, stored_with
from peerbench.operators.ordering import every_kth
from peerbench.operators.pareto import pareto
from peerbench.operators.scenario import scenario_days
from peerbench.operators.star import duplicate_texts, surplus_numbers
from peerbench.plans.clean import clean_fields, stay_band
from peerbench.plans.lake import Lake, model_figures
from peerbench.plans.layout import ENTITY, MODEL_TABLES, RELATIONSHIPS, STRATA
from peerbench.session import stored

PEER_TOLERANCE = 1e-10

# What every column of the model means; a contract column without an entry fails the contract.
MEANINGS = {
    "AgeGroup": "age band of the record",
    "AgeSort": "place of the age band, youngest first",
    "AdmissionType": "manner of admission",
    "BandSort": "place of the stay band, shortest first",
    "BedDaysLowerBound": "known days, or the cap for a capped stay",
    "BenchmarkEligible": "1 when the stay is known and has enough peers",
    "Charges": "billed charges in dollars",
    "Condition": "short condition label",
    "ConditionDescription": "condition wording of the source",
    "ConditionKey": "condition code, text",
    "DischargeKey": "number of the record in the order of its source id",
    "DischargeYear": "year, the only time grain",
    "Disposition": "status at discharge",
    "EDIndicator": "emergency department flag, Y or N",
    "EstimatedCost": "estimated cost in dollars",
    "ExactLOS": "known days of stay; blank when capped or invalid",
    "ExpectedLOS": "mean stay of the peers; blank when not eligible",
    "HospitalCounty": "county of the hospital",
    "HospitalKey": "hospital code, text with leading zeros",
    "HospitalName": "hospital name",
    "LOSCensored": "1 for a capped stay",
    "MortalityRisk": "risk category of the source",
    "PeerHospitals": "other hospitals in the stratum",
    "PeerN": "records of other hospitals in the stratum",
    "PrimaryPayer": "payment category",
    "ReductionPct": "scenario rate as a fraction",
    "Severity": "severity wording",
    "SeverityKey": "severity code",
    "StayBand": "ordered band of the stay",
}


def _rows(one_row: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Check rows from a one-row table; a check passes when observed equals expected."""
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.coalesce(observed == expected, F.lit(False)).alias("passed"),
            observed.cast("bigint").alias("observed"),
            expected.cast("bigint").alias("expected"),
        )
        for name, (observed, expected) in checks.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")


def _count(predicate: Column) -> Column:
    return F.count(F.when(predicate, 1))


def value_counts(df: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """``field``, ``value`` (text), ``n``: how often each value of each column occurs, from one pass."""
    pairs = [F.struct(F.lit(c).alias("field"), e.cast("string").alias("value")) for c, e in columns.items()]
    counts = df.select(F.explode(F.array(*pairs)).alias("_p")).groupBy("_p.field", "_p.value")
    return stored(counts.agg(F.count(F.lit(1)).alias("n")), name)


class Facts:
    """What the checks need, gathered once.

    Rows, money and eligibility come from the figures of the layers, without reading a layer.  The model is read
    once for the values of its keys, once for its stays per hospital and stratum and once for its row numbers, and
    the raw extract once for the values that are counted again, independently of the model.
    """

    def __init__(self, lake: Lake, keep_raw: bool = True):
        """Without ``keep_raw`` the stored extract is deleted as soon as the records are made and its values counted."""
        self.lake = lake
        listed = ("age_group", "apr_drg_code", "discharge_year", "health_service_area")
        again = clean_fields(lake.raw, *listed).withColumn("StayBand", stay_band())
        columns = {c: F.col(c) for c in (*listed, "StayBand", "ConditionKey")}
        self.raw_values = value_counts(again, columns, "raw-values")
        if not keep_raw:
            lake.drop_raw()
        self.model_values = lake.key_values.groupBy("field", "value").agg(F.sum("n").alias("n"))
        hospitals = lake.key_values.where(F.col("field") == ENTITY)
        name = F.get_json_object("attributes", "$.HospitalName").alias("HospitalName")
        self.hospitals = hospitals.select(F.col("value").alias(ENTITY), name, "n", "cost_cents")


def record_checks(facts: Facts) -> DataFrame:
    """Everything that the figures of the layers tell."""
    lake = facts.lake

    def layer(name: str) -> DataFrame:
        return lake.figures[name].select(F.struct("*").alias(name))

    days = lake.figures["model"].select(F.coalesce("matched_days", F.lit(0)).alias("ObservedMatchedDays"))
    scenario = scenario_days(days, rates=(0.0, 0.05, 0.1))

    def at(rate: float, factor: int) -> Column:
        chosen = F.max(F.when(F.col("ReductionPct") == rate, F.col("ScenarioBedDays")))
        return F.round(factor * chosen).cast("bigint")

    reduced = scenario.agg(
        at(0.1, 1000).alias("tenth"), at(0.05, 2000).alias("two_twentieths"), at(0.0, 1).alias("nothing")
    )
    # A hospital's name is looked up in its dimension, as a report does.
    names = lake.dimensions["Hospitals"].select(F.col(ENTITY).alias("_key"), "HospitalName")
    used = facts.model_values.where(F.col("field") == ENTITY)
    found = used.join(names, F.col("value").eqNullSafe(F.col("_key")), "left")
    unlabelled = found.where(F.col("HospitalName").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)))
    summed = facts.hospitals.agg(F.sum("cost_cents"))
    # Every side has one row.
    row = layer("model").select(
        "model",
        *[layer(name).select(F.struct(f"{name}.*")).scalar().alias(name) for name in ("raw", "records")],
        reduced.select(F.struct("*")).scalar().alias("scenario"),
        unlabelled.scalar().alias("unlabelled"),
        summed.scalar().alias("hospital_cost"),
    )
    zero, rows = F.lit(0), F.col("model.rows")
    found_checks = {
        "model rows equal raw rows": (rows, F.col("raw.rows")),
        "cost cents equal raw cost cents": (F.col("model.cost_cents"), F.col("raw.cost_cents")),
        "stay text is valid": (F.col("records.invalid_stays"), zero),
        "costs are positive": (F.col("records.costs_not_positive"), zero),
        "charges are positive": (F.col("records.charges_not_positive"), zero),
        "capped stays have no exact stay": (F.col("model.capped_with_exact"), zero),
        "eligible records have enough peers": (F.col("model.few_peers"), zero),
        "eligible records have enough peer hospitals": (F.col("model.few_hospitals"), zero),
        "exact and capped stays add up": (F.col("model.exact_stays") + F.col("model.capped_stays"), rows),
        "matched records do not exceed all": (F.greatest("model.matched", "model.rows"), rows),
        "ten percent is twice five percent": (F.col("scenario.tenth"), F.col("scenario.two_twentieths")),
        "zero percent is nothing": (F.col("scenario.nothing"), zero),
        "hospital name is present": (F.col("unlabelled"), zero),
        "hospital costs add up to the cohort": (F.col("hospital_cost"), F.col("raw.cost_cents")),
    }
    if lake.listed_rows is not None:
        found_checks["raw rows equal the manifest"] = (F.col("raw.rows"), F.lit(lake.listed_rows))
    if lake.rescued is not None:
        row = row.withColumn("set_aside", lake.rescued.agg(F.count(F.lit(1))).scalar())
        found_checks["no rows were set aside"] = (F.col("set_aside"), zero)
    return _rows(row, found_checks)


def key_checks(facts: Facts) -> DataFrame:
    """Unique keys and fact keys without a dimension row."""
    lake = facts.lake
    ids = duplicate_texts(lake.records, "SourceRowId").agg(F.count(F.lit(1)).alias("n"))
    numbers = surplus_numbers(lake.model, "DischargeKey")
    known = [
        lake.dimensions[table].select(F.lit(key).alias("field"), F.col(key).cast("string").alias("value"))
        for table, key in RELATIONSHIPS.items()
    ]
    used = facts.model_values.where(F.col("field").isin(list(RELATIONSHIPS.values())))
    gaps = _per_field(value_gaps(used, reduce(DataFrame.unionByName, known)), {k: t for t, k in RELATIONSHIPS.items()})
    return reduce(
        DataFrame.unionByName,
        [
            _rows(ids, {"source id is unique": (F.col("n"), F.lit(0))}),
            _rows(numbers, {"discharge key is unique": (F.col("repeated"), F.lit(0))}),
            _field_rows(gaps, {"key is unique": "repeated", "has no orphans": "unlisted"}),
        ],
    )


def _per_field(gaps: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row for every named field, with zeros where it has no gap, and its display ``name``."""
    listed = gaps.sparkSession.createDataFrame(list(names.items()), "field string, name string")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in gaps.columns if c != "field"]
    return listed.join(gaps, "field", "left").select("field", "name", *counts)


def _field_rows(gaps: DataFrame, checks: dict[str, str]) -> DataFrame:
    """A check for every field and count, which passes when the count is zero."""
    entries = [
        F.struct(
            F.concat_ws(" ", "name", F.lit(text)).alias("check"),
            (F.col(count) == 0).alias("passed"),
            F.col(count).cast("bigint").alias("observed"),
            F.lit(0).cast("bigint").alias("expected"),
        )
        for text, count in checks.items()
    ]
    return gaps.select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")


def domain_checks(facts: Facts) -> DataFrame:
    """Values that the domain does not list, and listed values that do not occur.

    Ages may be missing; conditions, years and areas must be exactly those listed.
    """
    domain = facts.lake.domain
    listed = {"age_group": domain.age_groups, "apr_drg_code": tuple(domain.condition_labels)}
    if domain.years:
        listed["discharge_year"] = domain.years
    if domain.areas:
        listed["health_service_area"] = domain.areas
    pairs = [(field, value) for field, values in listed.items() for value in values]
    allowed = facts.lake.spark.createDataFrame(pairs, "field string, value string")
    found = facts.raw_values.where(F.col("field").isin(list(listed)))
    gaps = _per_field(value_gaps(found, allowed), {field: field for field in listed})
    within_domain = _field_rows(gaps, {"is within its domain": "unlisted"})
    return within_domain.unionByName(
        _field_rows(gaps.where(F.col("field") != "age_group"), {"uses all of its domain": "unused"})
    )


def total_checks(facts: Facts) -> DataFrame:
    """The last Pareto point is everything, in millionths."""
    ranked = pareto(facts.hospitals, "HospitalName", "cost_cents")
    last = ranked.agg(F.round(F.max("share") * 1000000).cast("bigint").alias("last"))
    return _rows(last, {"last Pareto point is everything": (F.col("last"), F.lit(1000000))})


def distribution_checks(facts: Facts) -> DataFrame:
    """Counts per band and condition, from the model and independently from the raw extract.

    ``observed`` is the number of values whose counts differ or that one side lacks.
    """
    fields = ("StayBand", "ConditionKey")
    a, b = (
        counts.where(F.col("field").isin(list(fields))).select("field", "value", F.col("n").alias(name))
        for counts, name in ((facts.model_values, "_model"), (facts.raw_values, "_raw"))
    )
    b = b.withColumnsRenamed({"field": "_field", "value": "_value"})
    same = (F.col("field") == F.col("_field")) & F.col("value").eqNullSafe(F.col("_value"))
    both = a.join(b, same, "full").withColumn("field", F.coalesce("field", "_field"))
    gaps = both.groupBy("field").agg(_count(~F.col("_model").eqNullSafe(F.col("_raw"))).alias("differ"))
    return _field_rows(_per_field(gaps, {f: f"counts per {f}" for f in fields}), {"agree": "differ"})


def peer_reconciliation(lake: Lake) -> DataFrame:
    """Every stored hospital and stratum against totals taken directly from the stays of the model."""
    keys = [ENTITY, *STRATA]
    # One pass over the model: how often each stay occurs per hospital and stratum.
    stays = lake.model.filter(lake.domain.comparable()).groupBy(*keys, "ExactLOS").agg(F.count(F.lit(1)).alias("_n"))
    direct = leave_one_out_from_counts(
        stored(stays, "stay-counts"),
        ENTITY,
        STRATA,
        "ExactLOS",
        "_n",
        lake.domain.min_peers,
        lake.domain.min_entities,
    ).select(*keys, *[F.col(c).alias(f"_{c}") for c in ("peer_n", "peer_entities", "expected")])
    both = lake.benchmark.join(direct, keys, "full")

    def differs(column: str) -> Column:
        return _count(~F.col(column).eqNullSafe(F.col(f"_{column}")))

    far = ~within(F.col("expected"), F.col("_expected"), PEER_TOLERANCE)
    return both.agg(
        F.count(F.lit(1)).alias("strata"),
        differs("peer_n").alias("peer_n_differs"),
        differs("peer_entities").alias("peer_hospitals_differ"),
        _count(far).alias("expected_differs"),
    )


def peer_checks(facts: Facts) -> DataFrame:
    found = peer_reconciliation(facts.lake)
    bad = F.col("peer_n_differs") + F.col("peer_hospitals_differ") + F.col("expected_differs")
    return _rows(found, {"every stratum agrees with direct totals": (bad, F.lit(0))})


def peer_spot_check(lake: Lake) -> DataFrame:
    """Sampled strata against the plain mean of the peers' records."""
    keys = [ENTITY, *STRATA]
    eligible = lake.model.filter(F.col("BenchmarkEligible") == 1)
    strata = eligible.groupBy(*keys).agg(F.first("ExpectedLOS").alias("ExpectedLOS"))
    sample = every_kth(strata, [F.col(k) for k in keys])
    focal = sample.select(F.col(ENTITY).alias("_focal"), *STRATA, "ExpectedLOS")
    # The sample has fewer than 50 rows by construction, so a record meets at most that many.
    # Equal stays are counted once per hospital and stratum; the sample then meets these counts only.
    stays = (
        lake.model.filter(F.col("ExactLOS").isNotNull())
        .groupBy(*keys, "ExactLOS")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # The sample has fewer than 50 rows by construction.
    peers = stays.join(F.broadcast(focal), list(STRATA)).filter(F.col(ENTITY) != F.col("_focal"))
    days = F.sum(F.col("_n") * F.col("ExactLOS"))
    direct = peers.groupBy(F.col("_focal").alias(ENTITY), *STRATA, "ExpectedLOS").agg(
        F.sum("_n").alias("PeerRecords"), ratio(days, F.sum("_n")).alias("PeerMean")
    )
    return direct.withColumn(
        "passed", within(F.col("PeerMean"), F.col("ExpectedLOS"), PEER_TOLERANCE)
    )


def checks(lake: Lake) -> DataFrame:
    """All checks, one row each."""
    groups = (
        record_checks,
        key_checks,
        domain_checks,
        total_checks,
        distribution_checks,
        peer_checks,
    )
    facts = Facts(lake)
    return reduce(DataFrame.unionByName, [group(facts) for group in groups])


def damaged(raw: DataFrame) -> DataFrame:
    """A raw extract with known defects, told by the fourth and fifth part of its ids (line and quantity).

    Line 7 has a stay that is no number, line 6 costs nothing, line 5 has charges that are no money, line 4 is
    there twice, and quantity 1 has an age outside the domain.
    """
    part = F.split("source_row_id", "-")
    line, quantity = part[3], part[4]
    hurt = raw.withColumns(
        {
            "length_of_stay": F.when(line == "7", "abc").otherwise(F.col("length_of_stay")),
            "total_costs": F.when(line == "6", "0.00").otherwise(F.col("total_costs")),
            "total_charges": F.when(line == "5", "n/a").otherwise(F.col("total_charges")),
            "age_group": F.when(quantity == "1", "UNKNOWN").otherwise(F.col("age_group")),
        }
    )
    return hurt.unionByName(hurt.where(line == "4"))


DAMAGED_CHECKS = (
    "stay text is valid",
    "costs are positive",
    "charges are positive",
    "source id is unique",
    "age_group is within its domain",
    "model rows equal raw rows",
    "raw rows equal the manifest",
)


def damaged_checks(lake: Lake) -> DataFrame:
    """What the checks say of the damaged extract, for the checks that its defects concern."""
    facts = Facts(Lake(damaged(lake.raw), lake.domain, listed_rows=lake.listed_rows), keep_raw=False)
    parts = (record_checks(facts), key_checks(facts), domain_checks(facts))
    return reduce(DataFrame.unionByName, parts).where(F.col("check").isin(*DAMAGED_CHECKS))


def peer_reconciliation_damaged(lake: Lake) -> DataFrame:
    """The reconciliation with a stored benchmark that is wrong for some hospitals, told by the last digit of their key.

    Digit 5 is missing, 7 has a peer too many, 3 a peer hospital too few and 9 an expectation half as high again.
    """
    digit = F.substring(ENTITY, -1, 1)
    wrong = lake.benchmark.where(digit != "5").withColumns(
        {
            "peer_n": F.col("peer_n") + F.when(digit == "7", 1).otherwise(0),
            "peer_entities": F.col("peer_entities") - F.when(digit == "3", 1).otherwise(0),
            "expected": F.col("expected") * F.when(digit == "9", 1.5).otherwise(1.0),
        }
    )
    other = lake.with_layers(benchmark=stored(wrong, "benchmark-damaged"))
    return peer_reconciliation(other)


def damaged_model(model: DataFrame) -> DataFrame:
    """A model with known defects, told by the quantity in its source ids."""
    quantity = F.element_at(F.split("SourceRowId", "-"), -1)

    def on(number: int, value: Column, column: str) -> Column:
        return F.when(quantity == str(number), value).otherwise(F.col(column))

    hurt = {
        # A hospital that no dimension lists.
        "HospitalKey": on(3, F.lit("GONE"), "HospitalKey"),
        # Eligible records with too few peers, or too few peer hospitals.
        "PeerN": on(5, F.lit(1).cast("bigint"), "PeerN"),
        "PeerHospitals": on(6, F.lit(1).cast("bigint"), "PeerHospitals"),
        # Capped stays with an exact stay.
        "ExactLOS": F.when((quantity == "7") & (F.col("LOSCensored") == 1), 1).otherwise(F.col("ExactLOS")),
        # One record number many times.
        "DischargeKey": on(8, F.lit(1).cast("bigint"), "DischargeKey"),
        # More matched records than records.
        "BenchmarkEligible": on(9, F.lit(100), "BenchmarkEligible"),
        # A cent too much.
        "CostCents": on(10, F.col("CostCents") + 1, "CostCents"),
        # Another condition.
        "ConditionKey": on(11, F.lit("PROMO"), "ConditionKey"),
    }
    # Records that got lost.
    return model.where(quantity != "2").withColumns(hurt)


def damaged_dimensions(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Payers listed twice, the first band missing, and hospitals without a name where the key ends in 1."""
    unnamed = F.when(F.substring(ENTITY, -1, 1) != "1", F.col("HospitalName"))
    return dims | {
        "Payers": dims["Payers"].unionAll(dims["Payers"]),
        "StayBands": dims["StayBands"].where("BandSort > 1"),
        "Hospitals": dims["Hospitals"].withColumn("HospitalName", unnamed),
    }


def damaged_model_checks(lake: Lake) -> DataFrame:
    """What the checks say of a damaged model and its damaged dimensions."""
    model = stored_with(damaged_model(lake.model), "model-damaged", model_figures(lake.domain))
    other = lake.with_layers(_model=model, dimensions=damaged_dimensions(lake.dimensions))
    facts = Facts(other)
    return reduce(DataFrame.unionByName, [f(facts) for f in (record_checks, key_checks, distribution_checks)])


def layer_figures(lake: Lake) -> DataFrame:
    """``layer``, ``figure``, ``value`` (text) of every layer, as gathered while it was written."""
    return reduce(DataFrame.unionByName, [long_figures(row, name) for name, row in lake.figures.items()])


def manifest_rows(lake: Lake) -> DataFrame:
    """The rows that the manifest lists against those counted while each layer was written.

    Beside the layers there are two extracts that do not keep to the manifest: one with line 4 of its ids twice, one
    without line 7.
    """
    line = F.split("source_row_id", "-")[3]
    extracts = {
        "repeated extract": lake.raw.unionByName(lake.raw.where(line == "4")),
        "cut extract": lake.raw.where(line != "7"),
    }
    figures = dict(lake.figures)
    for name, rows in extracts.items():
        figures[name] = stored_with(rows, "extract", {"rows": F.count(F.lit(1))})[1]
    listed, read = F.lit(lake.listed_rows).cast("bigint"), F.col("rows")
    status = F.when(read == listed, "ok").when(read > listed, "more").otherwise("fewer")
    parts = [
        row.select(F.lit(name).alias("layer"), listed.alias("listed_rows"), read.alias("rows_read"), status.alias("status"))
        for name, row in figures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def contract_check(lake: Lake, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Each model table against its contract: columns, rows, undescribed columns, header rows as data."""
    tables = {"Discharges": lake.star().fact, **lake.dimensions} if tables is None else tables
    parts = []
    for name, columns in MODEL_TABLES.items():
        table = tables[name]
        texts = [c for c, kind in table.dtypes if kind == "string"]
        is_header = reduce(
            lambda a, b: a | b, [F.col(c) == F.lit(c) for c in texts], F.lit(False)
        )
        parts.append(
            table.agg(
                F.count(F.lit(1)).alias("rows"), _count(is_header).alias("header_rows")
            ).select(
                F.lit(name).alias("table"),
                F.lit(len(table.columns)).cast("bigint").alias("columns"),
                "rows",
                F.lit(len(set(columns) - set(table.columns))).cast("bigint").alias("missing_columns"),
                F.lit(len(set(table.columns) - set(columns))).cast("bigint").alias("extra_columns"),
                F.lit(sum(c not in MEANINGS for c in columns)).cast("bigint").alias("undescribed"),
                "header_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def contract_damaged(lake: Lake) -> DataFrame:
    """The contract check of tables that break it: a header as data, a lost, a foreign and an undescribed column."""
    fact, dims = lake.star().fact, lake.dimensions
    header = lake.spark.createDataFrame([("PrimaryPayer",)], "PrimaryPayer string")
    tables = {
        "Discharges": fact.drop("PeerN", "PeerHospitals"),
        **dims,
        "Payers": dims["Payers"].unionAll(header),
        "Severity": dims["Severity"].withColumnRenamed("Severity", "Note"),
        "Hospitals": dims["Hospitals"].withColumn("Beds", F.lit(0)),
    }
    return contract_check(lake, tables)
