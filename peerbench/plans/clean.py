"""Raw text records to typed records, and typed records to the benchmarked model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.text import band, lenient_int, parse_capped, short_label, to_cents, to_int
from peerbench.operators.benchmark import assign_expected, expected_fields, leave_one_out, with_benchmark
from peerbench.operators.figures import stored_with
from peerbench.operators.ordering import number_rows, placed_rows
from peerbench.operators.packing import pack, unpack
from peerbench.plans.layout import (
    BAND_EDGES,
    ENTITY,
    MODEL_TABLES,
    RAW_FIELDS,
    STAY_BANDS,
    STRATA,
    Domain,
)


# What follows from the text of a stay alone.
STAY_FIELDS = ("LOSCensored", "ExactLOS", "BedDaysLowerBound")


def stay_values(text: str) -> dict[str, Column]:
    """``STAY_FIELDS`` from the column ``text`` and its number, ``_stay``."""
    stay = parse_capped(F.col(text), number=F.col("_stay"))
    return dict(zip(STAY_FIELDS, (stay["censored"], stay["exact"], stay["lower_bound"])))


def stay_fields(rows: DataFrame) -> DataFrame:
    """Records with ``STAY_FIELDS`` from their ``SourceLOS``."""
    numbered = rows.withColumn("_stay", to_int(F.col("SourceLOS")))
    return numbered.withColumns(stay_values("SourceLOS")).drop("_stay")


def clean_fields(raw: DataFrame, *kept: str) -> DataFrame:
    """The typed fields of a trimmed extract, without the row key but with the ``kept`` columns.

    One row per source row: repeated rows stay, and so do rows with an unknown stay.
    """
    raw = raw.select(*kept, *RAW_FIELDS, to_int(F.col("length_of_stay")).alias("_stay"))
    stay = stay_values("length_of_stay")
    return raw.select(
        *kept,
        F.col("source_row_id").alias("SourceRowId"),
        F.col("permanent_facility_id").alias("HospitalKey"),
        F.col("facility_name").alias("HospitalName"),
        F.col("hospital_county").alias("HospitalCounty"),
        lenient_int(F.col("discharge_year")).alias("DischargeYear"),
        F.col("apr_drg_code").alias("ConditionKey"),
        F.col("apr_drg_description").alias("ConditionDescription"),
        lenient_int(F.col("apr_severity_of_illness_code")).alias("SeverityKey"),
        F.col("apr_severity_of_illness").alias("Severity"),
        F.col("age_group").alias("AgeGroup"),
        F.col("payment_typology_1").alias("PrimaryPayer"),
        F.col("type_of_admission").alias("AdmissionType"),
        F.col("patient_disposition").alias("Disposition"),
        F.col("apr_risk_of_mortality").alias("MortalityRisk"),
        F.col("emergency_department_indicator").alias("EDIndicator"),
        F.col("length_of_stay").alias("SourceLOS"),
        *[stay[name].alias(name) for name in STAY_FIELDS],
        to_cents(F.col("total_costs")).alias("CostCents"),
        to_cents(F.col("total_charges")).alias("ChargesCents"),
    )


def place_records(raw: DataFrame, figures: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Typed records of a trimmed extract, written in the order of the source id, and their figures."""
    rows, kept = raw.select(*RAW_FIELDS), ["source_row_id"]
    placed = unpack(placed_rows(pack(rows, kept), [F.col("source_row_id")]), rows, kept)
    return stored_with(clean_fields(placed, "_part", "_place"), "records", figures)


def clean_records(placed: DataFrame) -> DataFrame:
    """Typed records with ``DischargeKey``, 1..n in the order of the source id."""
    return number_rows(placed, "DischargeKey")


def benchmark_table(clean: DataFrame, domain: Domain, min_peers: int | None = None) -> DataFrame:
    """Peers and expected stay per hospital and stratum of the comparable records."""
    return leave_one_out(
        clean.filter(domain.comparable()),
        ENTITY,
        STRATA,
        "ExactLOS",
        domain.min_peers if min_peers is None else min_peers,
        domain.min_entities,
    )


def stay_band() -> Column:
    return band(F.col("ExactLOS"), BAND_EDGES, STAY_BANDS, F.col("LOSCensored"), STAY_BANDS[-1])


def model_records(clean: DataFrame, bench: DataFrame, packed: bool = False) -> DataFrame:
    """Typed records with their fixed expectation, eligibility and stay band.

    With ``packed`` the records are short while they meet the benchmark, for joins that shuffle.
    """
    if packed:
        kept, rows = [ENTITY, *STRATA], clean.drop(*STAY_FIELDS)
        met = unpack(with_benchmark(pack(rows, kept), bench, ENTITY, STRATA), rows, kept)
        assigned = expected_fields(stay_fields(met), clean.columns, "ExactLOS")
    else:
        assigned = assign_expected(clean, bench, ENTITY, STRATA, "ExactLOS")
    return assigned.withColumn("StayBand", stay_band())


def condition_label(domain: Domain) -> Column:
    return short_label(F.col("ConditionKey"), domain.condition_labels)


def fact_table(model: DataFrame) -> DataFrame:
    """The fact of the star schema: 21 columns, money as two-decimal dollars."""
    dollars = {
        "EstimatedCost": (F.col("CostCents").cast("decimal(18,2)") / 100).cast("decimal(18,2)"),
        "Charges": (F.col("ChargesCents").cast("decimal(18,2)") / 100).cast("decimal(18,2)"),
    }
    return model.select(
        *[dollars[c].alias(c) if c in dollars else F.col(c) for c in MODEL_TABLES["Discharges"]]
    )
