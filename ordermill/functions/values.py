"""Tolerant parsing of feed cells: a bad cell becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.schema import (
    DATE_FORMATS,
    EARLIEST_DATE,
    LATEST_DATE,
    MISSING_TOKENS,
    MONTH_FORMAT,
    NUMBER_PATTERN,
)

_TIME_LETTERS = set("HhKkmsSaAnN")


def blank_to_null(text: Column) -> Column:
    """NULL for the missing-cell texts, the text itself otherwise."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def parse_number(text: Column) -> Column:
    """DOUBLE value of a number text.

    The pattern guards the cast, which alone would take ``1d`` and turn ``nan``
    into a NaN that passes every ``> 0`` test.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """TIMESTAMP_NTZ value of a date text in the first format that fits.

    Formats without a time of day go through DATE, so no time zone is involved.
    """
    tries = []
    for pattern in formats:
        if _TIME_LETTERS & set(pattern):
            parsed = F.try_to_timestamp(text, F.lit(pattern))
        else:
            parsed = F.try_to_date(text, pattern)
        tries.append(parsed.cast("timestamp_ntz"))
    return within_date_bounds(F.coalesce(*tries))


def within_date_bounds(moment: Column) -> Column:
    """NULL for moments outside the supported date window."""
    earliest = F.lit(EARLIEST_DATE).cast("timestamp_ntz")
    latest = F.lit(LATEST_DATE).cast("timestamp_ntz")
    return F.when(moment.between(earliest, latest), moment)


def as_number(column: Column, dtype: T.DataType) -> Column:
    """DOUBLE from a feed column that is text or already numeric."""
    if isinstance(dtype, T.NumericType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    return parse_number(column)


def as_moment(
    column: Column, dtype: T.DataType, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    """TIMESTAMP_NTZ from a feed column that is text or already a date."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return within_date_bounds(column.cast("timestamp_ntz"))
    return parse_date(column, formats)


def month_text(moment: Column) -> Column:
    """``YYYY-MM`` text of a moment."""
    return F.date_format(moment, MONTH_FORMAT)


def is_present(*columns: str) -> Column:
    """True where none of the named columns is NULL."""
    test = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        test = test & F.col(name).isNotNull()
    return test
