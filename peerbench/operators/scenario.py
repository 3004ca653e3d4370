"""What a proportional reduction of matched days would mean.

The rates stand beside the data without a key.  They are few and fixed, so they travel as a literal array
inside each row instead of a joined table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import blank_minus

# The reduction rates on offer, and the rate used unless exactly one is chosen.
RATES = (0.0, 0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2)
DEFAULT_RATE = 0.05

# The steps of the bridge in order.
BRIDGE_STEPS = ("Observed matched days", "Illustrative reduction", "Scenario remaining days")


def rate_array(rates: Sequence[float] = RATES) -> Column:
    return F.array(*[F.lit(float(rate)) for rate in rates])


def selected_rate(
    chosen: Callable[[Column], Column] | None = None,
    rates: Sequence[float] = RATES,
    default: float = DEFAULT_RATE,
) -> Column:
    """The one rate that passes ``chosen``; the default when none or several do."""
    kept = F.array_distinct(F.filter(rate_array(rates), chosen) if chosen else rate_array(rates))
    return F.when(F.size(kept) == 1, F.try_element_at(kept, F.lit(1))).otherwise(F.lit(float(default)))


def scenario_days(
    totals: DataFrame, days: str = "ObservedMatchedDays", rates: Sequence[float] = RATES
) -> DataFrame:
    """Every row of ``totals`` at every rate: reduced and remaining days."""
    out = totals.withColumn("ReductionPct", F.explode(rate_array(rates)))
    reduced = F.col(days) * F.col("ReductionPct")
    return out.withColumn("ScenarioBedDays", reduced).withColumn(
        "ScenarioRemainingDays", blank_minus(F.col(days), reduced)
    )


def scenario_bridge(totals: DataFrame, rate: Column, days: str = "ObservedMatchedDays") -> DataFrame:
    """Three ordered steps per row of ``totals``: observed, signed reduction, remaining."""
    observed = F.col(days).cast("double")
    reduced = observed * rate
    values = (observed, -reduced, blank_minus(observed, reduced))
    steps = F.array(
        *[
            F.struct(
                F.lit(place).alias("StepSort"),
                F.lit(step).alias("Step"),
                value.alias("ScenarioBridgeValue"),
            )
            for place, (step, value) in enumerate(zip(BRIDGE_STEPS, values), 1)
        ]
    )
    kept = [c for c in totals.columns if c != days]
    return totals.select(*kept, F.explode(steps).alias("_s")).select(*kept, "_s.*")
