"""Upkeep of the leave-one-out benchmark when records arrive or are withdrawn.

A version keeps the parts of every entity and stratum (``own_n``, ``own_sum``) and the benchmark made from them.  The
next version adds the parts of new records and takes away those of withdrawn ones, and makes the benchmark anew only
for strata that one of them belongs to: all hospitals of such a stratum have new peers, those of all others have the
old ones.  Only the changed records are read.  Versions are written to folders of their own, so whoever has read the
expectations of one keeps them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.operators.benchmark import entity_strata, leave_one_out_from_parts
from peerbench.session import stored


@dataclass(frozen=True)
class Rules:
    """What is compared: entity, strata, value, and the support that an expectation needs."""

    entity: str
    strata: Sequence[str]
    value: str
    min_peers: int = 30
    min_entities: int = 3


@dataclass(frozen=True)
class Version:
    """Parts per entity and stratum, the benchmark made from them, and the strata that this version changed."""

    number: int
    parts: DataFrame
    benchmark: DataFrame
    touched: DataFrame


def _benchmark(parts: DataFrame, rules: Rules) -> DataFrame:
    return leave_one_out_from_parts(parts, rules.entity, rules.strata, rules.min_peers, rules.min_entities)


def first_version(records: DataFrame, rules: Rules) -> Version:
    """A benchmark made from all records; every stratum is new."""
    parts = stored(entity_strata(records, rules.entity, rules.strata, rules.value), "parts-1")
    touched = stored(parts.select(*rules.strata).distinct(), "touched-1")
    return Version(1, parts, stored(_benchmark(parts, rules), "benchmark-1"), touched)


def _matching(table: DataFrame, touched: DataFrame, strata: Sequence[str], how: str) -> DataFrame:
    other = touched.withColumnsRenamed({c: f"_t_{c}" for c in strata})
    return table.join(other, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in strata], how)


def next_version(version: Version, new: DataFrame, withdrawn: DataFrame, rules: Rules) -> Version:
    """The benchmark after records arrived and others, which were in it, were withdrawn."""
    keys, strata, number = [rules.entity, *rules.strata], list(rules.strata), version.number + 1
    sums = ("own_n", "own_sum")
    added = entity_strata(new, rules.entity, strata, rules.value)
    gone = entity_strata(withdrawn, rules.entity, strata, rules.value)
    gone = gone.select(*keys, *[(-F.col(c)).alias(c) for c in sums])
    changes = stored(
        added.unionByName(gone).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]), f"changes-{number}"
    )
    touched = stored(changes.select(*strata).distinct(), f"touched-{number}")
    parts = version.parts.unionByName(changes).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    # A hospital whose last record is withdrawn leaves the stratum.
    parts = stored(parts.where("own_n > 0"), f"parts-{number}")
    renewed = _benchmark(_matching(parts, touched, strata, "left_semi"), rules)
    kept = _matching(version.benchmark, touched, strata, "left_anti")
    return Version(number, parts, stored(kept.unionByName(renewed), f"benchmark-{number}"), touched)
