"""Typing and cleaning rules of the three feeds.

Each feed is typed, then deduplicated, then filtered. The order matters: if the
first copy of a key is bad, its later good copies must go too, so no filter may
run before the deduplication. Typing comes first since typed cells are smaller
in the shuffle than their texts.

Dates are read by stated formats or, with ``date_formats=None``, by the one that the
first dates of a feed are written in, which then holds for the whole feed.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.dates import format_of
from ordermill.functions.values import as_moment, as_number, is_present
from ordermill.operators.dedup import keep_first
from ordermill.schema import (
    CUSTOMER_COLUMNS,
    DATE_FORMATS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    SOURCE_ORDINAL,
    require_columns,
)

# Formats for all feeds, formats by feed, or None: look at the feed's first dates.
DateFormats = Sequence[str] | Mapping[str, Sequence[str]] | None

# Rows looked at for a date of a known shape; so many times more if they have none, and at most.
FIRST_ROWS, MORE_ROWS, MOST_ROWS = 1_000, 64, 64_000


@dataclass(frozen=True)
class FeedRules:
    """What one feed needs to become clean.

    ``dated`` tells the rows whose dates are looked at: those that are dropped
    before dates are read do not say how dates are written.
    """

    feed: str
    key: str
    columns: tuple[str, ...]
    numbers: tuple[str, ...]
    dates: tuple[str, ...]
    complete: Callable[[], Column]
    acceptable: Callable[[], Column]
    dated: Callable[[], Column] = lambda: F.lit(True)


CUSTOMERS = FeedRules(
    feed="customers",
    key="customer_id",
    columns=CUSTOMER_COLUMNS,
    numbers=(),
    dates=("signup_date",),
    complete=lambda: is_present("customer_name", "signup_date"),
    acceptable=lambda: F.lit(True),
    dated=lambda: is_present("customer_name"),
)
PRODUCTS = FeedRules(
    feed="products",
    key="product_id",
    columns=PRODUCT_COLUMNS,
    numbers=("price",),
    dates=(),
    complete=lambda: is_present("product_name", "price"),
    acceptable=lambda: F.lit(True),
)
ORDERS = FeedRules(
    feed="orders",
    key="order_id",
    columns=ORDER_COLUMNS,
    numbers=("quantity",),
    dates=("order_date",),
    complete=lambda: is_present("order_date", "quantity"),
    acceptable=lambda: F.col("quantity") > 0,
)


def infer_date_formats(
    raw: DataFrame,
    rules: FeedRules,
    order_by: str = SOURCE_ORDINAL,
    first_rows: Callable[[int], DataFrame] | None = None,
    strict: bool = False,
) -> tuple[str, ...]:
    """The format of the feed's first date, in row order, that has a known shape.

    Second copies of a key and rows that are dropped before dates are read do
    not count. Only the first rows are fetched, more of them while they hold no
    such date; ``first_rows(n)`` may give them in order, without a look at the
    whole feed. If there are dates of no known shape only, or rows but no
    dates at all, a warning says so and the default formats are given; ``strict``
    makes that an error. A feed whose dates are typed, or without rows, has the
    default formats.
    """
    dtypes = {field.name: field.dataType for field in raw.schema.fields}
    written = [name for name in rules.dates if isinstance(dtypes[name], T.StringType)]
    if not written:
        return DATE_FORMATS
    wanted, present, dated = FIRST_ROWS, [], 0
    while True:
        rows = first_rows(wanted) if first_rows else raw.orderBy(order_by).limit(wanted)
        found = rows.select(rules.key, rules.dated(), *written).collect()
        firsts: dict = {}
        for key, counts, *cells in found:
            firsts.setdefault(key, cells if counts else [])
        dated = sum(map(bool, firsts.values()))
        present = [cell for cells in firsts.values() for cell in cells if cell is not None]
        shape = next((shape for shape in map(format_of, present) if shape), None)
        if shape:
            return (shape,)
        if len(found) < wanted or wanted >= MOST_ROWS:
            break
        wanted *= MORE_ROWS
    if dated:
        seen = f"such as {', '.join(map(repr, present[:3]))}" if present else "all missing"
        message = f"no known date format in {rules.feed}.{written[0]} ({seen}); state date_formats"
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return DATE_FORMATS


def date_formats_of(
    raw: DataFrame, rules: FeedRules, order_by: str, date_formats: DateFormats
) -> Sequence[str]:
    """The formats for one feed: stated for it, stated for all, or inferred."""
    if isinstance(date_formats, Mapping):
        date_formats = date_formats.get(rules.feed)
    return infer_date_formats(raw, rules, order_by) if date_formats is None else date_formats


def typed_feed(
    raw: DataFrame,
    rules: FeedRules,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
) -> DataFrame:
    """The feed's own columns with their types, plus the row order."""
    require_columns(raw, (*rules.columns, order_by), rules.feed)
    dtypes = {field.name: field.dataType for field in raw.schema.fields}
    formats = date_formats_of(raw, rules, order_by, date_formats)

    def typed(name: str) -> Column:
        if name in rules.numbers:
            return as_number(F.col(name), dtypes[name])
        if name in rules.dates:
            return as_moment(F.col(name), dtypes[name], formats)
        return F.col(name).cast("string")

    return raw.select(*(typed(name).alias(name) for name in rules.columns), order_by)


def clean_feed(
    raw: DataFrame,
    rules: FeedRules,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
) -> DataFrame:
    """Typed, deduplicated, complete and acceptable rows of one feed."""
    firsts = keep_first(typed_feed(raw, rules, order_by, date_formats), rules.key, order_by)
    return firsts.filter(rules.complete() & rules.acceptable())


def clean_customers(
    raw: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
) -> DataFrame:
    """First customer per id, if it has a name and a readable signup date."""
    return clean_feed(raw, CUSTOMERS, order_by, date_formats)


def clean_products(raw: DataFrame, order_by: str = SOURCE_ORDINAL) -> DataFrame:
    """First product per id, if it has a name and a readable price."""
    return clean_feed(raw, PRODUCTS, order_by)


def clean_orders(
    raw: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
) -> DataFrame:
    """First order line per id, if it has a readable date and a quantity above 0."""
    return clean_feed(raw, ORDERS, order_by, date_formats)
