"""The stored layers of a data set: clean records, benchmark, model and dimensions.

Each layer is written once to the shared folder and read back by every analysis, so the joins, the ordering
and the peer expectation are computed once and the expectation stays fixed under any later filter.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.text import to_cents, trim_all, valid_capped
from peerbench.operators.benchmark import entity_summary, observed_matched, stratum_totals, whole_sum
from peerbench.operators.figures import blanks, bounds, stored_with
from peerbench.operators.star import Star, dimension
from peerbench.plans.binding import raw_stays, table_paths
from peerbench.plans.clean import (
    benchmark_table,
    clean_records,
    condition_label,
    fact_table,
    model_records,
    place_records,
)
from peerbench.plans.layout import (
    ENTITY_FIELDS,
    RAW_FIELDS,
    RELATIONSHIPS,
    STAY_BANDS,
    SUPPLY,
    Domain,
)
from peerbench.session import drop, meeting_small, sized, stored
from peerbench.sources.files import snapshot_state
from peerbench.sources.tables import store_partitioned
from peerbench.sources.literals import ordered_labels, scenario_table
from peerbench.sources.text import read_rescued, read_text_table


def _count(predicate: Column) -> Column:
    return F.count(F.when(predicate, 1))


def raw_figures() -> dict[str, Column]:
    """What the writing of a raw extract tells: rows, money, blanks of every field, first and last id."""
    return {
        "rows": F.count(F.lit(1)),
        "cost_cents": F.sum(to_cents(F.col("total_costs")).cast("decimal(20,0)")),
        "charges_cents": F.sum(to_cents(F.col("total_charges")).cast("decimal(20,0)")),
        **bounds(["source_row_id"]),
        **blanks(list(RAW_FIELDS)),
    }


def record_figures() -> dict[str, Column]:
    """What the writing of typed records tells: rows, money, bounds and values that are no stay or no money."""
    return {
        "rows": F.count(F.lit(1)),
        "cost_cents": whole_sum("CostCents"),
        "charges_cents": whole_sum("ChargesCents"),
        "exact_stays": F.count("ExactLOS"),
        "capped_stays": F.sum("LOSCensored"),
        "invalid_stays": _count(~valid_capped(F.col("SourceLOS"))),
        "costs_not_positive": _count(~F.coalesce(F.col("CostCents") > 0, F.lit(False))),
        "charges_not_positive": _count(~F.coalesce(F.col("ChargesCents") > 0, F.lit(False))),
        **bounds(["ExactLOS", "CostCents", "ChargesCents", "DischargeYear", "SeverityKey"]),
    }


def model_figures(domain: Domain) -> dict[str, Column]:
    """What the writing of the model tells: rows, money, and whether eligibility keeps its rules."""
    known, eligible = F.col("ExactLOS").isNotNull(), F.col("BenchmarkEligible") == 1
    return {
        "rows": F.count(F.lit(1)),
        "cost_cents": whole_sum("CostCents"),
        "exact_stays": F.count("ExactLOS"),
        "capped_stays": F.sum("LOSCensored"),
        "capped_with_exact": _count((F.col("LOSCensored") == 1) & known),
        "matched": F.sum("BenchmarkEligible"),
        "matched_days": observed_matched(),
        "few_peers": _count(eligible & (F.col("PeerN") < domain.min_peers)),
        "few_hospitals": _count(eligible & (F.col("PeerHospitals") < domain.min_entities)),
        **bounds(["DischargeKey", "PeerN", "PeerHospitals"]),
    }


# Keys of the model with the attributes that belong to each; dimensions and checks start from their values.
KEY_ATTRIBUTES = {
    "HospitalKey": ("HospitalName", "HospitalCounty"),
    "ConditionKey": ("ConditionDescription",),
    "SeverityKey": ("Severity",),
    "AgeGroup": (),
    "PrimaryPayer": (),
    "StayBand": (),
}


def key_values(model: DataFrame) -> DataFrame:
    """``field``, ``value`` (text), ``attributes`` (JSON), ``n``, and for hospitals ``cost_cents``: every key of the
    model with what belongs to it, from one pass."""
    options = {"ignoreNullFields": "false"}
    entries = [
        F.struct(
            F.lit(key).alias("field"),
            F.col(key).cast("string").alias("value"),
            (F.to_json(F.struct(*names), options) if names else F.lit(None).cast("string")).alias("attributes"),
            (F.col("CostCents") if key == ENTITY_FIELDS[0] else F.lit(None).cast("bigint")).alias("cents"),
        )
        for key, names in KEY_ATTRIBUTES.items()
    ]
    rows = model.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    return rows.groupBy("field", "value", "attributes").agg(
        F.count(F.lit(1)).alias("n"), whole_sum("cents").alias("cost_cents")
    )


class Lake:
    """Layers derived from one raw extract.

    ``listed_rows`` is the number of rows that the manifest of the extract gives, if there is one, and ``rescued`` the
    malformed rows that were set aside in reading.  Every layer has ``figures`` gathered while it was written.
    """

    def __init__(
        self,
        source: DataFrame,
        domain: Domain,
        folder: str = "",
        listed_rows: int | None = None,
        rescued: DataFrame | None = None,
    ):
        self.source = source
        self.rescued = rescued
        self.domain = domain
        self.folder = folder
        self.listed_rows = listed_rows
        self.spark: SparkSession = source.sparkSession

    def with_layers(self, **layers) -> Lake:
        """The same lake with other layers (attribute -> value); those that are written already are shared."""
        other = Lake(self.source, self.domain, self.folder, self.listed_rows, self.rescued)
        for name in ("_raw", "_records", "benchmark", "_model", "dimensions"):
            other.__dict__[name] = layers.get(name, getattr(self, name))
        return other

    @cached_property
    def _raw(self) -> tuple[DataFrame, DataFrame]:
        # A source made by joins has shuffles as well.
        with sized(self.spark, self.listed_rows or 0), meeting_small(self.spark):
            return stored_with(trim_all(self.source), "raw", raw_figures())

    @property
    def raw(self) -> DataFrame:
        """The all-text extract, surrounding whitespace removed."""
        return self._raw[0]

    @cached_property
    def rows(self) -> int:
        """How many rows the extract has, as counted while it was written."""
        return self._raw[1].first()["rows"]

    @cached_property
    def _records(self) -> tuple[DataFrame, DataFrame]:
        with sized(self.spark, self.rows):
            return place_records(self.raw, record_figures())

    @property
    def records(self) -> DataFrame:
        """Typed records without their key, for whatever does not need it."""
        return self._records[0]

    def drop_raw(self) -> None:
        """Make the records and delete the stored extract, for a lake that reads it no more; its figures stay."""
        _ = self.rows, self.records
        for folder in {file.rsplit("/", 1)[0] for file in self.raw.inputFiles()}:
            drop(self.spark, folder)

    @property
    def figures(self) -> dict[str, DataFrame]:
        """One row of figures for each written layer: raw, records, model."""
        return {"raw": self._raw[1], "records": self._records[1], "model": self._model[1]}

    @cached_property
    def clean(self) -> DataFrame:
        """Typed records with their key, which takes one small broadcast of range starts."""
        return clean_records(self.records)

    @cached_property
    def benchmark(self) -> DataFrame:
        with sized(self.spark, self.rows):
            return stored(benchmark_table(self.records, self.domain), "benchmark")

    @cached_property
    def _model(self) -> tuple[DataFrame, DataFrame]:
        clean, benchmark = self.clean, self.benchmark
        with sized(self.spark, self.rows):
            return stored_with(model_records(clean, benchmark, packed=True), "model", model_figures(self.domain))

    @property
    def model(self) -> DataFrame:
        return self._model[0]

    @cached_property
    def labelled(self) -> DataFrame:
        """The model with the short condition label beside its key."""
        return self.model.withColumn("Condition", condition_label(self.domain))

    def summary(self) -> DataFrame:
        return entity_summary(self.model, ENTITY_FIELDS, self.domain.min_matched)

    @cached_property
    def key_values(self) -> DataFrame:
        """Values of every key of the model, with attributes, counts and costs, from one pass."""
        return stored(key_values(self.model), "key-values")

    def _dimension(self, key: str) -> DataFrame:
        """Distinct values of a key with their attributes."""
        kinds = {f.name: f.dataType.simpleString() for f in self.model.schema}
        names = KEY_ATTRIBUTES[key]
        rows = self.key_values.where(F.col("field") == key)
        value = F.col("value").cast(kinds[key]).alias(key)
        if not names:
            return dimension(rows.select(value), key)
        kind = ", ".join(f"{name} {kinds[name]}" for name in names)
        attributes = rows.select(value, F.from_json("attributes", kind).alias("_a")).select(key, "_a.*")
        return dimension(attributes, key, names)

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        """The seven small tables of the star schema."""
        conditions = self._dimension("ConditionKey").withColumn("Condition", condition_label(self.domain))
        return {
            "Hospitals": stored(self._dimension("HospitalKey"), "hospitals"),
            "Conditions": stored(conditions, "conditions"),
            "Severity": stored(self._dimension("SeverityKey"), "severity"),
            "AgeGroups": ordered_labels(self.spark, self.domain.age_groups, "AgeGroup", "AgeSort"),
            "Payers": stored(self._dimension("PrimaryPayer"), "payers"),
            "StayBands": ordered_labels(self.spark, STAY_BANDS, "StayBand", "BandSort"),
            "Scenario": scenario_table(self.spark),
        }

    def views(self) -> None:
        """Register the layers as temporary views, under the names and columns that SQL users know."""
        keys = ["ConditionKey", "SeverityKey", "AgeGroup"]
        partials = self.benchmark.select("HospitalKey", *keys, "own_n", "own_sum")
        tables = {
            "raw_discharge": self.raw.withColumns(
                {
                    "CostCentsParsed": to_cents(F.col("total_costs")),
                    "ChargesCentsParsed": to_cents(F.col("total_charges")),
                }
            ),
            "clean_discharge": self.clean,
            "hospital_stratum": partials.toDF("HospitalKey", *keys, "HospitalN", "HospitalDays"),
            "cohort_stratum": stratum_totals(partials, keys).toDF(
                *keys, "CohortN", "CohortDays", "HospitalsInStratum"
            ),
            "benchmark": self.benchmark.select(
                "HospitalKey", *keys, "peer_n", "peer_entities", "expected"
            ).toDF("HospitalKey", *keys, "PeerN", "PeerHospitals", "ExpectedLOS"),
            "discharge_model": self.model,
            "hospital_summary": self.summary(),
        }
        for name, table in tables.items():
            table.createOrReplaceTempView(name)

    @cached_property
    def stored_fact(self) -> DataFrame:
        """The fact with a folder per condition and year, so slicers on either read only their folders."""
        return store_partitioned(fact_table(self.model), "fact", ["ConditionKey", "DischargeYear"])

    def stored_star(self) -> Star:
        """The star over the stored fact."""
        return Star(self.stored_fact, self.star().dims)

    def star(self) -> Star:
        dims = {name: (self.dimensions[name], key) for name, key in RELATIONSHIPS.items()}
        return Star(fact_table(self.model), dims)


def from_extract(
    spark: SparkSession,
    path: str | list[str],
    domain: Domain,
    manifest: DataFrame | None = None,
    rescue: bool = False,
) -> Lake:
    """Layers of a raw CSV extract, or of a folder of its pages.

    With a manifest (a column ``row_count``, the same in each of its rows) the checks compare the rows read.  A
    malformed row fails the read, or with ``rescue`` is set aside and counted by the checks.
    """
    rescued = None
    if rescue:
        rows, rescued = read_rescued(spark, path, RAW_FIELDS)
    else:
        rows = read_text_table(spark, path, RAW_FIELDS)
    listed = manifest.agg(F.max(F.col("row_count").cast("bigint"))).first()[0] if manifest is not None else None
    return Lake(rows, domain, listed_rows=listed, rescued=rescued)


_lakes: dict[tuple[str, str, str], Lake] = {}
_lock = threading.Lock()


def supply_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Layers of the supply-chain tables in ``sf_dir``, built once per application and state of the files."""
    state = snapshot_state(spark, table_paths(sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), state)
    with _lock:
        if key not in _lakes:
            # Every line item is a stay; the footers of its files tell how many there are.
            listed = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").count()
            _lakes[key] = Lake(raw_stays(spark, sf_dir), SUPPLY, sf_dir.rstrip("/"), listed)
        return _lakes[key]
