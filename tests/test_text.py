import math

from helpers import values
from pyspark.sql import functions as F

from ordermill.functions.text import bar, currency, pad_left, pad_right, thousands


def numbers(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "x double").coalesce(1)


def test_currency_matches_python_formatting(spark):
    cells = [1234.125, 1234.135, -1234.5, 0.0, 2.5, 1e9, 999999.995, 0.005, 1.115]
    found = values(numbers(spark, cells).select(currency(F.col("x")), currency(F.col("x"), 0)))
    assert found == [(f"₦{c:,.2f}", f"₦{c:,.0f}") for c in cells]


def test_currency_of_missing_and_infinite(spark):
    found = values(numbers(spark, [None, math.inf, -math.inf]).select(currency(F.col("x"))))
    assert found == [(None,), ("₦inf",), ("₦-inf",)]


def test_thousands_of_counts(spark):
    frame = spark.createDataFrame([(0,), (999,), (1234567,), (-1000,)], "n bigint").coalesce(1)
    assert [r[0] for r in values(frame.select(thousands(F.col("n"))))] == [
        "0", "999", "1,234,567", "-1,000",
    ]


def test_bars(spark):
    frame = spark.createDataFrame(
        [(30.0, 30.0), (15.9, 30.0), (0.9, 30.0), (1.0, 0.0), (None, 3.0), (-3.0, 3.0)],
        "v double, m double",
    ).coalesce(1)
    found = [r[0] for r in values(frame.select(bar(F.col("v"), F.col("m"))))]
    assert found == ["█" * 30, "█" * 15, "", "", "", ""]


def test_padding_never_cuts(spark):
    frame = spark.createDataFrame([("ab",), ("abcdef",)], "t string").coalesce(1)
    found = values(frame.select(pad_left(F.col("t"), 4), pad_right(F.col("t"), 4)))
    assert found == [("  ab", "ab  "), ("abcdef", "abcdef")]
