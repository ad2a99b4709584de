"""Left joins of orders to the cleaned dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.values import is_present

_LOOKUP_KEY = "_lookup_key"


def attach(
    facts: DataFrame, lookup: DataFrame, key: str, null_keys_match: bool = True
) -> DataFrame:
    """Left join to a lookup that is unique on ``key``; one row out per row in.

    A NULL key finds the lookup row with a NULL key unless ``null_keys_match``
    is off. No hint is given: Spark broadcasts the lookup if its size allows and
    shuffles both sides otherwise, where AQE cuts hot keys into slices.
    """
    other = lookup.withColumnRenamed(key, _LOOKUP_KEY)
    if null_keys_match:
        same = facts[key].eqNullSafe(other[_LOOKUP_KEY])
    else:
        same = facts[key] == other[_LOOKUP_KEY]
    return facts.join(other, same, "left").drop(_LOOKUP_KEY)


def match_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    null_keys_match: bool = True,
) -> DataFrame:
    """Orders with their customer and product cells and the ``is_valid`` flag."""
    with_customer = attach(
        orders,
        customers.select("customer_id", "customer_name", "city"),
        "customer_id",
        null_keys_match,
    )
    with_both = attach(
        with_customer,
        products.select("product_id", "product_name", "category", "price"),
        "product_id",
        null_keys_match,
    )
    return with_both.withColumn("is_valid", is_present("customer_name", "product_name"))


def match_counts(matched: DataFrame) -> DataFrame:
    """One row: matched rows, those without a customer or product, valid ones."""
    return matched.agg(
        F.count(F.lit(1)).alias("merged_rows"),
        F.count_if(F.col("customer_name").isNull()).alias("missing_customers"),
        F.count_if(F.col("product_name").isNull()).alias("missing_products"),
        F.count_if(is_present("customer_name", "product_name")).alias("valid_orders"),
    )
