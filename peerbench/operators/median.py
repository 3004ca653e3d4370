"""Exact medians without bringing a group's values together.

``narrowed_median`` looks at a whole-number column a few binary digits at a time: a small histogram per
group tells in which bucket the two middle ranks lie, and the next pass counts only inside those buckets.
Every pass is one column-pruned scan whose shuffle holds at most ``2**BITS`` counts per group and mapper, for
each bucket looked into: two at most per group, but those of all groups together where subtotals share records.

``ranked_median`` counts equal values, numbers them in order with running totals, and picks the middle rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerbench.operators.ordering import running
from peerbench.session import stored

BITS = 12


def narrowed_median(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    expand: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Key columns, ``low`` and ``high``: the two middle values, equal for odd counts.

    For subtotals, ``expand`` turns counts per ``by`` into rows per ``keys``, one for every subtotal that
    they belong to; it sees counts, never the records.
    """
    keys = list(by if keys is None else keys)
    rows = df.select(*by, F.col(value).cast("bigint").alias("_v")).filter(F.col("_v").isNotNull())
    bounds = rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    base, top = (0, 0) if bounds["lo"] is None else (bounds["lo"], bounds["hi"])
    rows = rows.select(*by, (F.col("_v") - F.lit(base)).alias("_v"))

    def counted(buckets: DataFrame) -> DataFrame:
        counts = buckets.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
        if expand:
            counts = expand(counts).groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
        return counts

    shift = max(0, (top - base).bit_length() - BITS)
    counts = counted(rows.select(*by, F.shiftright("_v", shift).alias("_b")))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    targets = F.explode(
        F.array(
            F.struct(F.lit("low").alias("_side"), F.expr("(_total + 1) div 2").alias("_rank")),
            F.struct(F.lit("high").alias("_side"), F.expr("(_total + 2) div 2").alias("_rank")),
        )
    )
    wanted = _buckets(
        counts.withColumn("_total", total).select("*", targets.alias("_t")).select("*", "_t.*"), keys
    )
    # Subtotals share their records, so then a bucket is kept for all groups when one of them wants it.
    match = list(by) if expand is None else []
    while shift > 0:
        wanted = stored(wanted, "median-buckets")
        step = min(BITS, shift)
        shift -= step
        inside = wanted.select(*match, F.col("_b").alias("_outer")).distinct()
        keyed = rows.select(*by, F.shiftright("_v", shift).alias("_b"))
        in_bucket = F.shiftright("_b", step) == F.col("r._outer")
        counts = counted(_join(keyed, inside, match, in_bucket, "left_semi"))
        ranked = wanted.select(*keys, F.col("_b").alias("_outer"), "_side", "_rank")
        wanted = _buckets(_join(counts, ranked, keys, in_bucket, "inner"), keys)
    side = {s: F.max(F.when(F.col("_side") == s, F.col("_b") + F.lit(base))) for s in ("low", "high")}
    return wanted.groupBy(*keys).agg(side["low"].alias("low"), side["high"].alias("high"))


def _buckets(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bucket that holds each wanted rank, and the rank inside it (a window over one histogram)."""
    up_to = F.sum("_n").over(
        Window.partitionBy(*by, "_side").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counts.withColumn("_upto", up_to)
        .filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
        .select(*by, "_b", "_side", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"))
    )


def _join(left: DataFrame, right: DataFrame, by: Sequence[str], on: Column, how: str) -> DataFrame:
    for name in by:
        on = on & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    joined = left.alias("l").join(right.alias("r"), on, how)
    if how == "left_semi":
        return joined
    extra = [f"r.{c}" for c in right.columns if c not in (*by, "_outer")]
    return joined.select("l.*", *extra)


def ranked_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """As ``narrowed_median``, by numbering the values and picking ranks (n+1) div 2 and (n+2) div 2."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = stored(counts, "median-counts")
    numbered = stored(running(counts, by, [F.col("_v")], ["_n"]), "median-ranks")
    totals = numbered.groupBy(*by).agg(F.sum("_n").alias("_total"))
    last, first = F.col("cum__n"), F.col("cum__n") - F.col("_n") + 1
    picks = {
        "low": F.expr("(_total + 1) div 2"),
        "high": F.expr("(_total + 2) div 2"),
    }
    on = F.lit(True)
    for name in by:
        on = on & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    joined = numbered.alias("l").join(totals.alias("r"), on).select("l.*", "_total")
    return joined.groupBy(*by).agg(
        *[F.max(F.when(rank.between(first, last), F.col("_v"))).alias(s) for s, rank in picks.items()]
    )


def median_cents(low: Column, high: Column) -> Column:
    """Middle of two cent values in dollars, rounded half up to cents."""
    return F.call_function("div", low + high + 1, F.lit(2)).cast("double") / F.lit(100.0)
