"""Ratios, exact rounding, blank-aware arithmetic, tolerance tests and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating ratio, NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Whole-number ratio rounded half away from zero, without going through binary fractions."""
    scaled = F.abs(numerator).cast("decimal(38,0)") * F.lit(2 * 10**digits)
    halves = F.when(denominator > 0, denominator.cast("decimal(20,0)"))
    units = F.call_function("div", scaled + halves, halves * 2)
    return F.signum(numerator.cast("double")) * units.cast("double") / F.lit(float(10**digits))


def blank_minus(a: Column, b: Column) -> Column:
    """Subtraction where one blank counts as 0 and two blanks stay blank."""
    zero = F.lit(0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) - F.coalesce(b, zero))


def within(a: Column, b: Column, tolerance: float) -> Column:
    """True where both are blank or differ by less than ``tolerance``."""
    both_blank = a.isNull() & b.isNull()
    return both_blank | F.coalesce(F.abs(a - b) < F.lit(tolerance), F.lit(False))


def fixed(value: Column, decimals: int) -> Column:
    """Text with a fixed number of decimals; blanks stay blank."""
    return F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", value.cast("double")))


def _grouped(number: Column, decimals: int) -> Column:
    """Text with thousands separators, rounded half away from zero."""
    return F.format_number(F.round(number, decimals), decimals)


def display(value: Column, style: str) -> Column:
    """Display text for one of the formats that the measure catalogue names."""
    number = value.cast("double")
    if style == "#,##0":
        text = _grouped(number, 0)
    elif style == "#,##0.0":
        text = _grouped(number, 1)
    elif style == "$#,##0":
        text = F.concat(F.lit("$"), _grouped(number, 0))
    elif style == "0.0":
        text = fixed(number, 1)
    elif style == "0.00":
        text = fixed(number, 2)
    elif style == "0.0%":
        text = F.concat(fixed(number * 100, 1), F.lit("%"))
    elif style == "0.00%":
        text = F.concat(fixed(number * 100, 2), F.lit("%"))
    elif style == '0.00"x"':
        text = F.concat(fixed(number, 2), F.lit("x"))
    elif style == "+#,##0.0;-#,##0.0;0.0":
        magnitude = _grouped(F.abs(number), 1)
        text = (
            F.when(number > 0, F.concat(F.lit("+"), magnitude))
            .when(number < 0, F.concat(F.lit("-"), magnitude))
            .otherwise(F.lit("0.0"))
        )
    else:
        raise ValueError(f"unknown display format {style!r}")
    return F.when(value.isNotNull(), text)
