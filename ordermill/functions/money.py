"""Rounding, and sums of money that do not depend on partition order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quantities are added to this many decimals.
UNIT_DIGITS = 6


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back, all in DOUBLE."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def line_amount(quantity: Column, price: Column) -> Column:
    """Quantity times price in cents; NULL if a part is missing or undefined."""
    amount = round_half_even(quantity * price, 2)
    return F.when(~F.isnan(amount), amount)


def exact_sum(name: str, digits: int) -> Column:
    """Aggregate: the sum of a DOUBLE column to ``digits`` decimals, 0.0 if nothing is there.

    Whole units go through DECIMAL(30,0) and fractions through BIGINT, both exact,
    so any number of partitions gives the same total, and no total that a DOUBLE
    can show overflows: units would need 10^12 rows of 9 * 10^18. From 2^63 on a DOUBLE
    has no fraction and goes through DECIMAL(38,0). Infinite amounts, and finite
    ones past what DECIMAL holds, are added as DOUBLE. The result is a DOUBLE,
    so of a total past 2^53 hundredths the last digits are rounded away.
    """
    scale = 10**digits
    amount = F.col(name)
    fits = F.abs(amount) < float(2**63)
    whole = F.floor(amount)
    parts = F.rint((amount - whole) * scale).cast("bigint")
    wide = F.when(~fits, amount.try_cast("decimal(38,0)"))
    beyond = F.when(~fits & wide.isNull(), amount)
    wholes = F.coalesce(F.sum(F.when(fits, whole).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    fractions = F.coalesce(F.sum(F.when(fits, parts)), F.lit(0))
    carried = (fractions - F.pmod(fractions, F.lit(scale))) / scale
    wides = F.when(F.count(wide) > 0, F.coalesce(F.try_sum(wide).cast("double"), F.sum(wide.cast("double"))))
    units = (wholes + carried.cast("decimal(20,0)")).cast("double") + F.pmod(fractions, F.lit(scale)) / scale
    return units + F.coalesce(wides, F.lit(0.0)) + F.coalesce(F.sum(beyond), F.lit(0.0))


def money_sum(name: str) -> Column:
    """Aggregate: the exact sum of an amount column in cents, 0.0 if nothing is there."""
    return exact_sum(name, 2)


def money_mean(name: str) -> Column:
    """Aggregate: money sum over the number of present amounts; NULL if none."""
    return F.try_divide(money_sum(name), F.count(name))


def unit_sum(name: str) -> Column:
    """Aggregate: the sum of quantities to a millionth, 0.0 if nothing is there."""
    return exact_sum(name, UNIT_DIGITS)


def percent_of(part: Column, whole: Column, digits: int = 1) -> Column:
    """Part as a rounded percentage of whole; NULL if whole is 0."""
    return round_half_even(F.try_divide(part, whole) * 100, digits)
