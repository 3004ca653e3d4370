"""Rank, running total and cumulative share of an amount by entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio
from peerbench.operators.ordering import running
from peerbench.session import stored


def pareto(df: DataFrame, entity: str, amount: str, partition: Sequence[str] = ()) -> DataFrame:
    """Entities from the largest to the smallest total of a whole-number ``amount``.

    Output: ``partition``, ``entity``, ``amount``, ``rank`` (gaps after ties), ``cumulative`` and ``share``.
    Entities are ordered by amount, then name; tied entities share the running total that ends at the first
    of the tie, since the running total covers as many entities as the rank says.  A NULL partition is a
    partition, and NULL amounts tie with each other, behind all others.
    """
    by = list(partition)
    # Written once: the ranges are chosen from the totals before they are put in order.
    totals = stored(df.groupBy(*by, entity).agg(F.sum(amount).alias(amount)), "pareto-totals")
    order = [F.col(amount).desc(), F.col(entity).asc()]
    ordered = stored(running(totals, by, order, [amount], "_position", "_cum_"), "pareto")
    ties = (
        ordered.groupBy(*by, amount)
        .agg(
            F.count(F.lit(1)).alias("_tied"),
            F.min("_position").alias("_rank"),
            F.min_by(f"_cum_{amount}", "_position").alias("_shared"),
        )
        .filter(F.col("_tied") > 1)
    )
    ranked = _joined(ordered, ties, [*by, amount], "left").select(
        *by,
        entity,
        amount,
        F.coalesce("_rank", "_position").alias("rank"),
        F.coalesce("_shared", f"_cum_{amount}").alias("cumulative"),
    )
    if by:
        whole = ordered.groupBy(*by).agg(F.sum(amount).alias("_whole"))
        ranked = _joined(ranked, whole, by, "inner")
    else:
        ranked = ranked.withColumn("_whole", ordered.agg(F.sum(amount)).scalar())
    return ranked.withColumn("share", ratio(F.col("cumulative"), F.col("_whole"))).drop("_whole")


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """``left`` with the other columns of ``right``, NULL keys being equal to each other."""
    other = right.withColumnsRenamed({name: f"_r_{name}" for name in by})
    same = [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in by]
    return left.join(other, same, how).drop(*[f"_r_{name}" for name in by])
