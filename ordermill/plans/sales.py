"""The sales fact: clean, match, derive, project."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import line_amount
from ordermill.functions.values import is_present, month_text
from ordermill.operators.clean import DateFormats, clean_customers, clean_orders, clean_products
from ordermill.operators.match import match_orders
from ordermill.schema import DATE_FORMATS, SALES_COLUMNS, SOURCE_ORDINAL


def merged_orders(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
    null_keys_match: bool = True,
) -> DataFrame:
    """Clean orders of the three raw feeds with both lookups and ``is_valid``."""
    return match_orders(
        clean_orders(orders, order_by, date_formats),
        clean_customers(customers, order_by, date_formats),
        clean_products(products, order_by),
        null_keys_match,
    )


def sales_of(merged: DataFrame, valid_only: bool = False) -> DataFrame:
    """The twelve fact columns of merged orders.

    With ``valid_only`` both left joins below become inner joins.
    """
    kept = merged.filter("is_valid") if valid_only else merged
    return (
        kept.withColumn("total_amount", line_amount(F.col("quantity"), F.col("price")))
        .withColumn("year_month", month_text(F.col("order_date")))
        .select(*SALES_COLUMNS)
    )


def build_sales_summary(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    valid_only: bool = False,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
    null_keys_match: bool = True,
) -> DataFrame:
    """The sales fact of three raw feeds, unsorted.

    Text dates are read by ``date_formats``; ``None`` has the first rows of the
    feeds looked at for the format, in a job of their own.
    ``valid_only=False`` keeps orders without a customer or product, as the
    batch reports want; ``True`` drops them, as the dashboard reports want.
    """
    merged = merged_orders(
        customers, products, orders, order_by, date_formats, null_keys_match
    )
    return sales_of(merged, valid_only)


def valid_sales(sales: DataFrame) -> DataFrame:
    """The valid rows of a fact that was built with unmatched orders.

    Clean lookups have no NULL names, so a name tells whether a match was found.
    One stored fact can thus serve the batch and the dashboard reports.
    """
    return sales.filter(is_present("customer_name", "product_name"))


def in_date_order(sales: DataFrame) -> DataFrame:
    """Sales by date, then order id. For showing and exporting, not for reports."""
    return sales.orderBy("order_date", "order_id")
