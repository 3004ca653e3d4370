"""Leave-one-entity-out expectation and what follows from it.

A record's expectation is the mean of the records of all *other* entities in its stratum.  It is computed
as stratum total minus own part, from two small aggregates; no record ever meets another record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio
from peerbench.session import stored


def entity_strata(df: DataFrame, entity: str, strata: Sequence[str], value: str) -> DataFrame:
    """Per entity and stratum: ``own_n`` and ``own_sum``."""
    return df.groupBy(entity, *strata).agg(
        F.count(F.lit(1)).alias("own_n"), F.sum(value).alias("own_sum")
    )


def stratum_totals(partials: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Per stratum, from the entity parts: ``total_n``, ``total_sum`` and the number of ``entities``."""
    return partials.groupBy(*strata).agg(
        F.sum("own_n").alias("total_n"),
        F.sum("own_sum").alias("total_sum"),
        F.count(F.lit(1)).alias("entities"),
    )


def leave_one_out(
    df: DataFrame,
    entity: str,
    strata: Sequence[str],
    value: str,
    min_peers: int = 30,
    min_entities: int = 3,
    drop_unsupported: bool = False,
) -> DataFrame:
    """Peers and expected value per entity and stratum.

    Output: entity, strata, ``own_n``, ``own_sum``, ``peer_n``, ``peer_entities``, ``expected``.  Without
    enough peer records or peer entities ``expected`` is NULL, or the row is left out.
    """
    partials = entity_strata(df, entity, strata, value)
    return _minus_own(
        partials, stratum_totals(partials, strata), entity, strata, min_peers, min_entities, drop_unsupported
    )


def leave_one_out_from_parts(
    partials: DataFrame, entity: str, strata: Sequence[str], min_peers: int = 30, min_entities: int = 3
) -> DataFrame:
    """The same result from the parts of all entities (``own_n``, ``own_sum``)."""
    return _minus_own(partials, stratum_totals(partials, strata), entity, strata, min_peers, min_entities, False)


def leave_one_out_from_records(
    df: DataFrame,
    entity: str,
    strata: Sequence[str],
    value: str,
    min_peers: int = 30,
    min_entities: int = 3,
) -> DataFrame:
    """The same result with stratum totals taken from the records, not from the entity parts."""
    totals = df.groupBy(*strata).agg(
        F.count(F.lit(1)).alias("total_n"),
        F.sum(value).alias("total_sum"),
        F.count_distinct(entity).alias("entities"),
    )
    partials = entity_strata(df, entity, strata, value)
    return _minus_own(partials, totals, entity, strata, min_peers, min_entities, False)


def leave_one_out_from_counts(
    counts: DataFrame,
    entity: str,
    strata: Sequence[str],
    value: str,
    weight: str,
    min_peers: int = 30,
    min_entities: int = 3,
) -> DataFrame:
    """The same result from how often each value occurs per entity and stratum (``weight``).

    Totals are taken from the counts of all entities, not from the entity parts.
    """
    amounts = [F.sum(weight).alias("n"), F.sum(F.col(value) * F.col(weight)).alias("sum")]
    totals = counts.groupBy(*strata).agg(*amounts, F.count_distinct(entity).alias("entities"))
    partials = counts.groupBy(entity, *strata).agg(*amounts)
    return _minus_own(
        partials.withColumnsRenamed({"n": "own_n", "sum": "own_sum"}),
        totals.withColumnsRenamed({"n": "total_n", "sum": "total_sum"}),
        entity,
        strata,
        min_peers,
        min_entities,
        False,
    )


def _minus_own(
    partials: DataFrame,
    totals: DataFrame,
    entity: str,
    strata: Sequence[str],
    min_peers: int,
    min_entities: int,
    drop_unsupported: bool,
) -> DataFrame:
    peers = partials.join(totals, list(strata)).select(
        entity,
        *strata,
        "own_n",
        "own_sum",
        (F.col("total_n") - F.col("own_n")).alias("peer_n"),
        (F.col("entities") - 1).alias("peer_entities"),
        (F.col("total_sum") - F.col("own_sum")).alias("_peer_sum"),
    )
    supported = (F.col("peer_n") >= min_peers) & (F.col("peer_entities") >= min_entities)
    if drop_unsupported:
        peers = peers.filter(supported)
    expected = F.when(supported, ratio(F.col("_peer_sum"), F.col("peer_n")))
    return peers.withColumn("expected", expected).drop("_peer_sum")


def assign_expected(
    df: DataFrame, bench: DataFrame, entity: str, strata: Sequence[str], value: str
) -> DataFrame:
    """Records with PeerN, PeerHospitals, ExpectedLOS and BenchmarkEligible.

    The peer counts are filled for every record of a stratum, the expectation only where ``value`` is known.
    """
    return expected_fields(with_benchmark(df, bench, entity, strata), df.columns, value)


def with_benchmark(df: DataFrame, bench: DataFrame, entity: str, strata: Sequence[str]) -> DataFrame:
    """Records with what the benchmark tells of their entity and stratum."""
    keys = [entity, *strata]
    return df.join(bench.select(*keys, "peer_n", "peer_entities", "expected"), keys, "left")


def expected_fields(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """The ``columns`` of records that met the benchmark, and what it means for each."""
    known = F.col(value).isNotNull()
    return df.select(
        *columns,
        F.col("peer_n").alias("PeerN"),
        F.col("peer_entities").alias("PeerHospitals"),
        F.when(known, F.col("expected")).alias("ExpectedLOS"),
        (known & F.col("expected").isNotNull()).cast("int").alias("BenchmarkEligible"),
    )


def observed_matched() -> Column:
    """Sum of known values over matched records."""
    return F.sum(F.when(F.col("BenchmarkEligible") == 1, F.col("ExactLOS")))


def index(matched: Column, observed: Column, expected: Column, min_matched: int) -> Column:
    """Observed over expected, blank below ``min_matched`` matched records."""
    return F.when(matched >= min_matched, ratio(observed, expected))


def whole_sum(column: str) -> Column:
    """Sum of whole numbers that may exceed 64 bits."""
    return F.sum(F.col(column).cast("decimal(20,0)"))


def entity_sums(model: DataFrame, entity_cols: Sequence[str]) -> DataFrame:
    """One row per entity with whole-number sums: ``TotalCostCents``, ``ExactDays`` and counts."""
    return model.groupBy(*entity_cols).agg(
        F.count(F.lit(1)).alias("Discharges"),
        F.count("ExactLOS").alias("ExactLOSDischarges"),
        F.sum("ExactLOS").alias("ExactDays"),
        F.sum("LOSCensored").alias("CensoredDischarges"),
        whole_sum("CostCents").alias("TotalCostCents"),
        F.count("CostCents").alias("_cost_n"),
        F.sum("BenchmarkEligible").alias("MatchedDischarges"),
        observed_matched().alias("MatchedObservedDays"),
        F.sum("ExpectedLOS").alias("MatchedExpectedDays"),
    )


def entity_summary(model: DataFrame, entity_cols: Sequence[str], min_matched: int = 30) -> DataFrame:
    """One row per entity: counts, averages, money in dollars, coverage and the standardised index."""
    return entity_sums(model, entity_cols).select(
        *entity_cols,
        "Discharges",
        "ExactLOSDischarges",
        ratio(F.col("ExactDays"), F.col("ExactLOSDischarges")).alias("AvgExactLOS"),
        "CensoredDischarges",
        (F.col("TotalCostCents").cast("double") / 100).alias("TotalEstimatedCost"),
        (ratio(F.col("TotalCostCents"), F.col("_cost_n")) / 100).alias("AvgEstimatedCost"),
        "MatchedDischarges",
        ratio(F.col("MatchedDischarges"), F.col("Discharges")).alias("BenchmarkCoverage"),
        "MatchedObservedDays",
        "MatchedExpectedDays",
        index(
            F.col("MatchedDischarges"),
            F.col("MatchedObservedDays"),
            F.col("MatchedExpectedDays"),
            min_matched,
        ).alias("LOSIndex"),
    )


def sensitivity(
    records: DataFrame,
    summary: DataFrame,
    entity: str,
    strata: Sequence[str],
    value: str,
    min_matched: int = 30,
    min_peers: int = 30,
) -> DataFrame:
    """Index rebuilt from ``records`` (already filtered), beside the index in ``summary``.

    Peers are rebuilt among the given records only; strata without support are left out.
    """
    peers = leave_one_out(records, entity, strata, value, min_peers, drop_unsupported=True)
    rebuilt = (
        peers.groupBy(entity)
        .agg(
            F.sum("own_n").alias("MatchedDischarges"),
            F.sum("own_sum").alias("_observed"),
            F.sum(F.col("own_n") * F.col("expected")).alias("_expected"),
        )
        .filter(F.col("MatchedDischarges") >= min_matched)
    )
    primary = summary.select(entity, "HospitalName", "LOSIndex")
    return rebuilt.join(primary, entity).select(
        entity,
        "HospitalName",
        "MatchedDischarges",
        ratio(F.col("_observed"), F.col("_expected")).alias("SensitivityLOSIndex"),
        F.col("LOSIndex").alias("PrimaryLOSIndex"),
    )


def movement(sensitivity_table: DataFrame) -> DataFrame:
    """Entities whose index changed, and the largest change between the two indices."""
    change = F.abs(F.col("SensitivityLOSIndex") - F.col("PrimaryLOSIndex"))
    return sensitivity_table.agg(
        F.count(F.lit(1)).alias("Hospitals"),
        F.max(change).alias("LargestMovement"),
        F.avg(change).alias("MeanMovement"),
    )


def group_shares(df: DataFrame, by: Sequence[str], amounts: dict[str, str]) -> DataFrame:
    """Share of each group in the total of every amount (name -> whole-number column, ``*`` for rows)."""
    sums = df.groupBy(*by).agg(
        *[
            (F.count(F.lit(1)) if column == "*" else F.sum(column)).alias(name)
            for name, column in amounts.items()
        ]
    )
    # Written once, so that the totals are taken from the few groups and not from the records again.
    sums = stored(sums, "group-sums")
    whole = {name: sums.agg(F.sum(name)).scalar() for name in amounts}
    return sums.select(
        *by,
        *amounts,
        *[ratio(F.col(name), whole[name]).alias(f"{name}Share") for name in amounts],
    )
