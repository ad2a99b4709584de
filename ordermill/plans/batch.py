"""Reports of the batch run, on a fact that keeps unmatched orders.

A group with a NULL key is no group: such rows are dropped before grouping.
All reports give raw numbers; see ``present`` for display text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.money import (
    money_mean,
    money_sum,
    percent_of,
    round_half_even,
    unit_sum,
)
from ordermill.functions.text import bar, pad_left, pad_right, thousands
from ordermill.functions.values import is_present
from ordermill.operators.rank import ranked, top_k
from ordermill.schema import CURRENCY_SIGN

AMOUNT = "total_amount"
CUSTOMER_KEYS = ("customer_id", "customer_name", "city")
PRODUCT_KEYS = ("product_id", "product_name", "category")


def by_group(sales: DataFrame, keys: tuple[str, ...], **measures: Column) -> DataFrame:
    """Aggregate ``measures`` over rows whose ``keys`` are all present.

    Plain NULL tests, unlike ``dropna``, are pushed down to the scan.
    """
    return (
        sales.filter(is_present(*keys))
        .groupBy(*keys)
        .agg(*(measure.alias(name) for name, measure in measures.items()))
    )


def total_revenue(sales: DataFrame) -> DataFrame:
    """One row: the sum of all amounts."""
    return sales.agg(money_sum(AMOUNT).alias("total_revenue"))


def average_order_value(sales: DataFrame) -> DataFrame:
    """One row: the mean of the amounts that are present."""
    return sales.agg(money_mean(AMOUNT).alias("average_order_value"))


def top_customers(sales: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` customers who spent most, with their rank."""
    spent = by_group(sales, CUSTOMER_KEYS, total_amount=money_sum(AMOUNT))
    return ranked(top_k(spent, k, "total_amount", CUSTOMER_KEYS), "total_amount", CUSTOMER_KEYS)


def best_products(sales: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` products sold most often, with their rank."""
    sold = by_group(
        sales,
        PRODUCT_KEYS,
        units_sold=unit_sum("quantity"),
        revenue=money_sum(AMOUNT),
    )
    return ranked(top_k(sold, k, "units_sold", PRODUCT_KEYS), "units_sold", PRODUCT_KEYS)


def category_revenue_share(sales: DataFrame) -> DataFrame:
    """Revenue per category and its share of the revenue of all rows.

    Rows without a category count in the total but are no group. The total is
    taken over the category rows, NULL one included, so the fact is read once;
    that window holds one row per category.
    """
    per_category = sales.groupBy("category").agg(money_sum(AMOUNT).alias("revenue"))
    everything = round_half_even(F.sum("revenue").over(Window.partitionBy()), 2)
    return (
        per_category.withColumn("share_pct", percent_of(F.col("revenue"), everything))
        .filter(F.col("category").isNotNull())
        .orderBy(F.desc("revenue"), F.asc("category"))
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Revenue per month with a bar scaled to the best month, in month order.

    The window holds one row per month.
    """
    monthly = by_group(sales, ("year_month",), revenue=money_sum(AMOUNT))
    best = F.max("revenue").over(Window.partitionBy())
    return monthly.withColumn("bar", bar(F.col("revenue"), best)).orderBy("year_month")


def trend_lines(trend: DataFrame) -> DataFrame:
    """The monthly trend as one fixed-width text line per month."""
    amount = pad_left(thousands(F.col("revenue"), 2), 14)
    return trend.select(
        "year_month",
        F.concat(
            F.lit("  "),
            F.col("year_month"),
            F.lit("  "),
            pad_right(F.col("bar"), 32),
            F.lit(f"  {CURRENCY_SIGN}"),
            amount,
        ).alias("line"),
    ).orderBy("year_month")


def run_summary(sales: DataFrame) -> DataFrame:
    """One row: orders, revenue, mean, distinct customers and products, dates."""
    return sales.agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(AMOUNT).alias("total_revenue"),
        money_mean(AMOUNT).alias("average_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
        F.min("order_date").cast("date").alias("first_date"),
        F.max("order_date").cast("date").alias("last_date"),
    )
