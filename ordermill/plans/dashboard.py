"""Dashboard reports, on a valid-only fact after ``apply_filters``.

Each report is one grouped aggregate that reads only the columns it names.
Partial sums run before every shuffle, so a group that holds most of the rows
costs one row per task; distinct counts shuffle by (group, value) first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.money import money_mean, money_sum, percent_of, round_half_even, unit_sum
from ordermill.operators.rank import ranked, top_k, top_k_ascending
from ordermill.plans.batch import AMOUNT, CUSTOMER_KEYS, PRODUCT_KEYS, by_group

NAMED_PRODUCT_KEYS = ("product_name", "category")
HISTOGRAM_BINS = 20
# A century; wider tables serve no reader.
MOST_MONTHS = 1200


def _orders() -> Column:
    return F.count("order_id")


def kpis(sales: DataFrame) -> DataFrame:
    """One row of six key figures; all 0 on an empty selection."""
    zero = F.lit(0.0)
    return sales.agg(
        money_sum(AMOUNT).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
        F.coalesce(money_mean(AMOUNT), zero).alias("avg_order_value"),
        F.coalesce(F.max(AMOUNT), zero).alias("largest_order"),
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per month, in month order."""
    return by_group(sales, ("year_month",), revenue=money_sum(AMOUNT)).orderBy("year_month")


def category_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per category, largest first, with its share of what is shown.

    The window holds one row per category.
    """
    shown = by_group(sales, ("category",), revenue=money_sum(AMOUNT))
    total = round_half_even(F.sum("revenue").over(Window.partitionBy()), 2)
    return shown.withColumn("share_pct", percent_of(F.col("revenue"), total)).orderBy(
        F.desc("revenue"), F.asc("category")
    )


def category_revenue_ascending(sales: DataFrame) -> DataFrame:
    """Revenue per category, largest last."""
    return by_group(sales, ("category",), revenue=money_sum(AMOUNT)).orderBy(
        "revenue", "category"
    )


def top_cities(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` cities with the most revenue, largest last."""
    cities = by_group(sales, ("city",), revenue=money_sum(AMOUNT))
    return top_k_ascending(cities, k, "revenue", ("city",))


def monthly_orders(sales: DataFrame) -> DataFrame:
    """Revenue and number of orders per month, in month order."""
    return by_group(
        sales, ("year_month",), revenue=money_sum(AMOUNT), orders=_orders()
    ).orderBy("year_month")


def monthly_average(sales: DataFrame) -> DataFrame:
    """Average order value per month, in month order."""
    return by_group(sales, ("year_month",), avg_order_value=money_mean(AMOUNT)).orderBy(
        "year_month"
    )


def heatmap_long(sales: DataFrame) -> DataFrame:
    """Revenue per month and category that occur together."""
    return by_group(sales, ("year_month", "category"), revenue=money_sum(AMOUNT))


def _months(sales: DataFrame) -> DataFrame:
    """One row: the months that occur in a category, in order."""
    month = F.when(F.col("category").isNotNull(), F.col("year_month"))
    return sales.agg(F.array_sort(F.collect_set(month)).alias("months"))


def heatmap_dense(sales: DataFrame) -> DataFrame:
    """Revenue per category and month, 0.0 where they do not occur together.

    Each category keeps its months in a map and is spread over the list of all
    months, a single value that the calendar bounds. Work and rows grow with
    categories times months and are spread over tasks.
    """
    cell = F.struct("year_month", "revenue")
    per_category = (
        heatmap_long(sales)
        .groupBy("category")
        .agg(F.map_from_entries(F.collect_list(cell)).alias("revenue_of"))
    )
    return (
        per_category.select("category", "revenue_of", F.explode(_months(sales).scalar()).alias("year_month"))
        .select(
            "category",
            "year_month",
            F.coalesce(F.col("revenue_of")[F.col("year_month")], F.lit(0.0)).alias("revenue"),
        )
        .orderBy("category", "year_month")
    )


def heatmap_matrix(sales: DataFrame, months: list[str] | None = None) -> DataFrame:
    """Revenue with categories as rows and months as columns, 0.0 where empty.

    Columns must be known to plan the pivot: without ``months`` their list is
    fetched first, in a job that reads the month column alone. More than
    ``MOST_MONTHS`` are refused.
    """
    if months is None:
        months = _months(sales).first().months
    if len(months) > MOST_MONTHS:
        raise ValueError(f"{len(months)} months are too many for columns; pass the months to show")
    wide = heatmap_long(sales).groupBy("category").pivot("year_month", months).agg(F.sum("revenue"))
    return wide.fillna(0.0).orderBy("category")


def top_products_by_units(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` product names with the most units, largest last."""
    products = by_group(sales, NAMED_PRODUCT_KEYS, units=unit_sum("quantity"))
    return top_k_ascending(products, k, "units", NAMED_PRODUCT_KEYS)


def top_products_by_revenue(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` product names with the most revenue, largest last."""
    products = by_group(sales, NAMED_PRODUCT_KEYS, revenue=money_sum(AMOUNT))
    return top_k_ascending(products, k, "revenue", NAMED_PRODUCT_KEYS)


def product_bubble(sales: DataFrame) -> DataFrame:
    """Units, revenue and orders per category and product name."""
    return by_group(
        sales,
        ("category", "product_name"),
        units=unit_sum("quantity"),
        revenue=money_sum(AMOUNT),
        orders=_orders(),
    )


def product_table(sales: DataFrame) -> DataFrame:
    """Units, orders and revenue of every product, largest revenue first."""
    return by_group(
        sales,
        PRODUCT_KEYS,
        units_sold=unit_sum("quantity"),
        orders=_orders(),
        revenue=money_sum(AMOUNT),
    ).orderBy(F.desc("revenue"), *PRODUCT_KEYS)


def top_spenders(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers who spent most, largest last."""
    spent = by_group(sales, CUSTOMER_KEYS, total_amount=money_sum(AMOUNT))
    return top_k_ascending(spent, k, "total_amount", CUSTOMER_KEYS)


def orders_per_customer(sales: DataFrame) -> DataFrame:
    """Number of orders of each customer."""
    return by_group(sales, ("customer_id",), order_count=_orders())


def orders_histogram(sales: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Customers per range of order counts, in at most ``bins`` equal ranges.

    ``bin_start`` and ``bin_end`` are both included. Customers are first counted
    per order count; the window sees only those rows, of which n orders can
    give no more than the square root of 2n.
    """
    spread = (
        orders_per_customer(sales).groupBy("order_count").agg(F.count(F.lit(1)).alias("customers"))
    )
    whole = Window.partitionBy()
    lowest = F.min("order_count").over(whole)
    span = F.max("order_count").over(whole) - lowest + 1
    width = F.ceil(span / bins)
    return (
        spread.select("order_count", "customers", lowest.alias("lowest"), width.alias("width"))
        .withColumn("bin", F.floor((F.col("order_count") - F.col("lowest")) / F.col("width")))
        .groupBy("bin", "lowest", "width")
        .agg(F.sum("customers").alias("customers"))
        .select(
            "bin",
            (F.col("lowest") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lowest") + (F.col("bin") + 1) * F.col("width") - 1).alias("bin_end"),
            "customers",
        )
        .orderBy("bin")
    )


def customers_by_city(sales: DataFrame, k: int = 12, approximate: bool = False) -> DataFrame:
    """The ``k`` cities with the most distinct customers, largest last.

    ``approximate`` trades exact counts for one shuffle of small sketches.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    cities = by_group(sales, ("city",), customers=count("customer_id"))
    return top_k_ascending(cities, k, "customers", ("city",))


def average_spend_by_city(sales: DataFrame, k: int = 12) -> DataFrame:
    """The ``k`` cities with the largest average order, largest last."""
    cities = by_group(sales, ("city",), avg_spend=money_mean(AMOUNT))
    return top_k_ascending(cities.dropna(subset=["avg_spend"]), k, "avg_spend", ("city",))


def customer_table(sales: DataFrame, k: int = 50) -> DataFrame:
    """Orders, spending and average order of the ``k`` best customers, ranked."""
    customers = by_group(
        sales,
        CUSTOMER_KEYS,
        orders=_orders(),
        total_spent=money_sum(AMOUNT),
        avg_order=money_mean(AMOUNT),
    )
    best = top_k(customers, k, "total_spent", CUSTOMER_KEYS)
    return ranked(best, "total_spent", CUSTOMER_KEYS)
