"""Column expressions that turn source text into typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that counts as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

DIGITS = "0123456789"


def trim(text: Column) -> Column:
    """Strip surrounding whitespace, Unicode included.

    Most texts begin and end with a visible ASCII character, which two comparisons tell; only the others
    are searched.
    """
    last = F.substring(text, -1, 1)
    clean = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def trim_all(df: DataFrame) -> DataFrame:
    """``trim`` on every string column."""
    return df.select(
        *[trim(F.col(name)).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes]
    )


def to_int(text: Column) -> Column:
    """Whole number or NULL."""
    return text.try_cast("int")


def lenient_int(text: Column) -> Column:
    """Leading whole number of a text, 0 where there is none (the behaviour of a lenient CAST)."""
    # Plain numbers need no pattern.
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    return F.when(text.isNotNull(), F.coalesce(to_int(text), digits.try_cast("int"), F.lit(0)))


def _money_parts(text: Column) -> tuple[Column, Column, Column]:
    """Sign (1 or -1), whole cents without the sign, and the digits behind them; NULL where it is not money.

    Money is an optional sign, digits and at most one point among them; exponents are not.  The digits are taken
    from the text, so no number of decimals is rounded away.  Amounts beyond the range of whole cents in 64 bits
    are NULL, which the checks of positive money report.
    """
    bare = F.btrim(text)
    first = F.substring(bare, 1, 1)
    signed = (first == "-") | (first == "+")
    number = F.when(signed, F.substring(bare, F.lit(2), F.length(bare))).otherwise(bare)
    others = F.translate(number, DIGITS, "")
    money = ((others == "") | (others == ".")) & (F.length(number) > F.length(others))
    point = F.instr(number, ".")
    decimals = F.when(point > 0, F.substring(number, point + 1, F.length(number))).otherwise("")
    cents = F.concat(F.substring_index(number, ".", 1), F.rpad(F.substring(decimals, 1, 2), 2, "0"))
    sign = F.when(first == "-", -1).otherwise(1)
    return sign, F.when(money, cents.try_cast("bigint")), F.substring(decimals, F.lit(3), F.length(decimals))


def to_cents(text: Column) -> Column:
    """Decimal text to whole cents, cutting off fractions of a cent."""
    sign, cents, _ = _money_parts(text)
    return sign * cents


def half_even_cents(text: Column) -> Column:
    """Decimal text to whole cents, rounding half a cent to the even neighbour."""
    sign, cents, rest = _money_parts(text)
    half = F.rtrim(rest, F.lit("0")) == "5"
    up = F.when(half, cents % 2 == 1).otherwise(rest >= "5")
    return sign * (cents + up.cast("bigint"))


def parse_capped(
    text: Column,
    sentinel: str = "120+",
    cap: int = 120,
    lo: int = 1,
    hi: int = 119,
    number: Column | None = None,
) -> dict[str, Column]:
    """Split a capped numeric text into ``censored`` (0/1), ``exact`` and ``lower_bound``.

    ``exact`` is NULL for the sentinel and for anything outside ``lo``..``hi``.  ``number`` is the text as a
    whole number where the caller has it already.
    """
    number = to_int(text) if number is None else number
    is_capped = F.coalesce(text == sentinel, F.lit(False))
    exact = F.when(~is_capped & number.between(lo, hi), number)
    return {
        "censored": is_capped.cast("int"),
        "exact": exact,
        "lower_bound": F.when(is_capped, F.lit(cap)).otherwise(exact),
    }


def valid_capped(text: Column, sentinel: str = "120+", lo: int = 1, hi: int = 119) -> Column:
    """True where a text is the sentinel or plain digits within ``lo``..``hi``."""
    digits = text.rlike("^[0-9]+$") & F.coalesce(to_int(text).between(lo, hi), F.lit(False))
    return F.coalesce((text == sentinel) | digits, F.lit(False))


def band(
    value: Column,
    edges: Sequence[int],
    labels: Sequence[str],
    censored: Column,
    censored_label: str,
) -> Column:
    """Ordered band label: first edge that ``value`` does not exceed.

    Values beyond the last edge, and NULLs that are not censored, get the last label.
    """
    chain = F.when(censored == 1, F.lit(censored_label))
    for edge, label in zip(edges, labels):
        chain = chain.when(value <= edge, F.lit(label))
    return chain.otherwise(F.lit(labels[len(edges)]))


def short_label(code: Column, labels: dict[str, str]) -> Column:
    """Code to display label; unknown codes give NULL."""
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), code)
