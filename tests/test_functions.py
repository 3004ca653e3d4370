from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from peerbench.functions import numbers, text


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        (" 001464 ", "001464"),
        ("\t001464\n", "001464"),
        (" 001464 ", "001464"),
        ("a b", "a b"),
        ("　", ""),
        ("", ""),
        ("été", "été"),
        ("\x1fx\x85", "x"),
    ],
)
def test_trim(spark, value, expected):
    df = text.trim_all(spark.createDataFrame([(value, 1)], "a string, n int"))
    assert df.first() == (expected, 1)


def test_trim_agrees_with_python(spark):
    codes = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = [(c, f"{chr(c)}x{chr(c)}") for c in codes]
    df = text.trim_all(spark.createDataFrame(rows, "c int, s string"))
    assert [r.s for r in df.orderBy("c").collect()] == [s.strip() for _, s in rows]


@pytest.mark.parametrize(
    "value, cents, even",
    [("12.34", 1234, 1234), ("12.349", 1234, 1235), ("0.01", 1, 1), ("0.125", 12, 12), ("0.135", 13, 14),
     ("7", 700, 700), ("x", None, None), ("", None, None), ("99999999999.99", 9999999999999, 9999999999999),
     ("0.0099999999999999", 0, 1), ("0.00500000000000000000001", 0, 1), ("0.005", 0, 0), ("0.015", 1, 2),
     ("90000000000000000.019", 9000000000000000001, 9000000000000000002), ("-1.239", -123, -124), (".5", 50, 50)],
)
def test_cents(spark, value, cents, even):
    assert one(spark, text.to_cents(F.col("v")), v=value) == cents
    assert one(spark, text.half_even_cents(F.col("v")), v=value) == even
    if cents is not None:
        assert cents == int(Decimal(value) * 100)


@pytest.mark.parametrize(
    "value, parsed, valid",
    [
        ("120+", (1, None, 120), True),
        ("1", (0, 1, 1), True),
        ("119", (0, 119, 119), True),
        ("0", (0, None, None), False),
        ("120", (0, None, None), False),
        ("abc", (0, None, None), False),
        ("", (0, None, None), False),
        ("-5", (0, None, None), False),
        (None, (0, None, None), False),
    ],
)
def test_parse_capped(spark, value, parsed, valid):
    df = spark.createDataFrame([(value,)], "v string")
    row = df.select(
        *text.parse_capped(F.col("v")).values(), text.valid_capped(F.col("v")).alias("ok")
    ).first()
    assert tuple(row) == (*parsed, valid)


@pytest.mark.parametrize(
    "value, expected", [("12abc", 12), (" -7", -7), ("junk", 0), ("", 0), ("+3", 3), (None, None)]
)
def test_lenient_int(spark, value, expected):
    assert one(spark, text.lenient_int(F.col("v")), v=value) == expected


@pytest.mark.parametrize(
    "num, den, digits, expected",
    [(1, 8, 2, 0.13), (5115, 1000, 2, 5.12), (-5115, 1000, 2, -5.12), (2, 3, 0, 1.0), (0, 5, 2, 0.0),
     (1, 0, 2, None), (9007199254740993, 2, 0, 4503599627370497.0)],
)
def test_rounded_ratio(spark, num, den, digits, expected):
    assert one(spark, numbers.rounded_ratio(F.col("a"), F.col("b"), digits), a=num, b=den) == expected


def test_blank_minus_and_within(spark):
    rows = [(1, 5.0, 3.0), (2, None, 3.0), (3, 5.0, None), (4, None, None)]
    df = spark.createDataFrame(rows, "k int, a double, b double").orderBy("k")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(numbers.blank_minus(a, b)).collect()] == [2.0, -3.0, 5.0, None]
    assert [r[0] for r in df.select(numbers.within(a, b, 2.5)).collect()] == [True, False, False, True]


@pytest.mark.parametrize(
    "value, style, expected",
    [
        (1234.0, "#,##0", "1,234"),
        (34823.4, "#,##0.0", "34,823.4"),
        (1234.5, "$#,##0", "$1,235"),
        (0.5, "0.0%", "50.0%"),
        (0.99881, "0.00%", "99.88%"),
        (1.2, '0.00"x"', "1.20x"),
        (-359.2087, "+#,##0.0;-#,##0.0;0.0", "-359.2"),
        (12.0, "+#,##0.0;-#,##0.0;0.0", "+12.0"),
        (0.0, "+#,##0.0;-#,##0.0;0.0", "0.0"),
        (7.749, "0.00", "7.75"),
        (5.0, "0.0", "5.0"),
    ],
)
def test_display(spark, value, style, expected):
    assert one(spark, numbers.display(F.col("v"), style), v=value) == expected


def test_band_edges(spark):
    from peerbench.plans.clean import stay_band

    days = [1, 2, 3, 5, 6, 10, 11, 20, 21, 30, 31, 119]
    df = spark.createDataFrame([(d, 0) for d in days] + [(None, 1), (None, 0)], "ExactLOS int, LOSCensored int")
    got = [r[0] for r in df.coalesce(1).select(stay_band()).collect()]
    assert got == ["1-2 days"] * 2 + ["3-5 days"] * 2 + ["6-10 days"] * 2 + ["11-20 days"] * 2 + [
        "21-30 days"
    ] * 2 + ["31-119 days"] * 2 + ["120+ days", "31-119 days"]


def test_short_label(spark):
    df = spark.createDataFrame([("139",), ("999",), (None,)], "k string")
    assert [r[0] for r in df.select(text.short_label(F.col("k"), {"139": "Pneumonia"})).collect()] == [
        "Pneumonia",
        None,
        None,
    ]
