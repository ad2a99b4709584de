import math
import random
from decimal import Decimal

import pandas as pd
from helpers import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions.money import (
    line_amount,
    money_mean,
    money_sum,
    percent_of,
    round_half_even,
    unit_sum,
)

QUIET = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def amounts(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "x double")


def test_rounding_samples(spark):
    cells = {1.005: 1.0, 2.675: 2.68, 0.125: 0.12, 0.375: 0.38, 1.115: 1.12, 0.725: 0.72, -1.005: -1.0}
    found = values(amounts(spark, cells).coalesce(1).select(round_half_even(F.col("x"), 2)))
    assert [row[0] for row in found] == list(cells.values())


@QUIET
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200))
def test_rounding_agrees_with_pandas(spark, cells):
    found = values(amounts(spark, cells).coalesce(1).select(round_half_even(F.col("x"), 2)))
    assert [row[0] for row in found] == pd.Series(cells).round(2).tolist()


@QUIET
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=300))
def test_money_sum_is_exact(spark, cents):
    frame = amounts(spark, [c / 100 for c in cents])
    assert values(frame.agg(money_sum("x"))) == [(float(Decimal(sum(cents)) / 100),)]


def test_money_sum_does_not_depend_on_order(spark):
    chance = random.Random(5)
    cells = [round(chance.uniform(-1e6, 1e6), 2) for _ in range(5000)]
    totals = set()
    for parts in (1, 3, 16):
        chance.shuffle(cells)
        totals.add(values(amounts(spark, cells).repartition(parts).agg(money_sum("x")))[0][0])
    assert len(totals) == 1


def test_money_sum_of_nothing(spark):
    assert values(amounts(spark, []).agg(money_sum("x"), money_mean("x"), unit_sum("x"))) == [
        (0.0, None, 0.0)
    ]
    groups = spark.createDataFrame([("a", None), ("a", None), ("b", 2.5)], "k string, x double")
    found = groups.groupBy("k").agg(money_sum("x"), money_mean("x"), unit_sum("x")).orderBy("k")
    assert values(found) == [("a", 0.0, None, 0.0), ("b", 2.5, 2.5, 2.5)]


def test_money_sum_beyond_cents_and_at_infinity(spark):
    assert values(amounts(spark, [4e15, 3e15, 0.25]).agg(money_sum("x"))) == [(7e15 + 0.25,)]
    assert values(amounts(spark, [math.inf, 1.0]).agg(money_sum("x"))) == [(math.inf,)]
    # More than 2^63 cents in all.
    many = spark.range(200_000).select(F.lit(9.0e11).alias("x"))
    assert values(many.agg(money_sum("x"))) == [(1.8e17,)]


def test_no_total_overflows(spark):
    many = spark.range(11_000_000).select(F.lit(9.0e11).alias("x"))
    assert values(many.agg(money_sum("x"))) == [(9.9e18,)]
    assert values(amounts(spark, [2.0**63, 2.0**63, 2.0**62]).agg(money_sum("x"))) == [(2.5 * 2.0**63,)]
    assert values(amounts(spark, [1e300, 1.0]).agg(money_sum("x"))) == [(1e300,)]
    assert values(amounts(spark, [-math.inf, 1e20]).agg(money_sum("x"))) == [(-math.inf,)]
    assert values(amounts(spark, [-1.25, -0.5, 1e13 + 0.25]).agg(money_sum("x"))) == [(1e13 - 1.5,)]


def test_unit_sum_does_not_depend_on_order(spark):
    chance = random.Random(9)
    cells = [round(chance.uniform(0, 100), 3) for _ in range(4000)]
    totals = set()
    for parts in (1, 3, 7, 16):
        chance.shuffle(cells)
        totals.add(values(amounts(spark, cells).repartition(parts).agg(unit_sum("x")))[0][0])
    assert totals == {float(sum(Decimal(str(c)) for c in cells))}


def test_line_amount(spark):
    frame = spark.createDataFrame(
        [(2.0, 1.005), (3.0, None), (math.inf, 0.0), (math.inf, 2.0)], "q double, p double"
    )
    found = frame.coalesce(1).select(line_amount(F.col("q"), F.col("p")))
    assert [row[0] for row in values(found)] == [2.01, None, None, math.inf]


def test_percent(spark):
    frame = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (0.0, 3.0)], "a double, b double")
    found = frame.coalesce(1).select(percent_of(F.col("a"), F.col("b")))
    assert [row[0] for row in values(found)] == [33.3, None, 0.0]
