"""Text for reports: currency, thousands, bars, padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schema import BAR_CHARACTER, BAR_WIDTH, CURRENCY_SIGN


def thousands(value: Column, digits: int = 0) -> Column:
    """Number text with thousands commas, ties to even."""
    infinite = F.lit(float("inf"))
    return (
        F.when(value == infinite, F.lit("inf"))
        .when(value == -infinite, F.lit("-inf"))
        .otherwise(F.format_number(value, digits))
    )


def currency(value: Column, digits: int = 2) -> Column:
    """Currency text; NULL stays NULL."""
    return F.concat(F.lit(CURRENCY_SIGN), thousands(value, digits))


def bar(value: Column, largest: Column, width: int = BAR_WIDTH) -> Column:
    """A bar as long as value's part of largest; empty if largest is 0 or NULL."""
    length = (F.try_divide(value, largest) * width).try_cast("int")
    return F.coalesce(F.repeat(F.lit(BAR_CHARACTER), length), F.lit(""))


def pad_right(text: Column, width: int) -> Column:
    """Text filled with blanks on the right; longer text is left whole."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def pad_left(text: Column, width: int) -> Column:
    """Text filled with blanks on the left; longer text is left whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))
