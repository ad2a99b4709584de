"""Data-quality counts.

All counters are plain aggregates. Observed metrics would come free with the
load, but they count a task again when it is rerun after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators.clean import (
    CUSTOMERS,
    ORDERS,
    PRODUCTS,
    DateFormats,
    FeedRules,
    typed_feed,
)
from ordermill.operators.dedup import keep_first_counting
from ordermill.operators.match import attach
from ordermill.schema import DATE_FORMATS, SOURCE_ORDINAL

# The stages of the cleaning funnel and the counter behind each.
FUNNEL_STAGES = (
    ("Raw Customers", "raw_customers"),
    ("Clean Customers", "clean_customers"),
    ("Raw Products", "raw_products"),
    ("Clean Products", "clean_products"),
    ("Raw Orders", "raw_orders"),
    ("Clean Orders", "clean_orders"),
    ("Valid Orders", "valid_orders"),
)
QUALITY_COUNTERS = (
    "raw_customers",
    "clean_customers",
    "raw_products",
    "clean_products",
    "raw_orders",
    "clean_orders",
    "missing_customers",
    "missing_products",
    "valid_orders",
)


def _raw_rows() -> Column:
    return F.coalesce(F.sum("copies"), F.lit(0))


def audited(
    raw: DataFrame,
    rules: FeedRules,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """First rows of each key: copies, outcome of the rules, and ``carried`` columns.

    The rules are judged before the deduplication, which does not change what they
    say of a row, so that only flags and carried cells go through the shuffle.
    """
    typed = typed_feed(raw, rules, order_by, date_formats)
    judged = typed.select(
        rules.key,
        order_by,
        *(name for name in carried if name != rules.key),
        rules.complete().alias("is_complete"),
        (rules.complete() & rules.acceptable()).alias("is_clean"),
    )
    return keep_first_counting(judged, rules.key, order_by)


def counted(audited_feed: DataFrame, rules: FeedRules) -> DataFrame:
    """Counts of one audited feed: raw, clean and removed rows, and rejected quantities."""
    rejected = F.count_if(F.col("is_complete") & ~F.col("is_clean"))
    has_quantity = F.lit("quantity" in rules.columns)
    return audited_feed.agg(
        F.lit(rules.feed).alias("feed"),
        _raw_rows().alias("raw_rows"),
        F.count_if("is_clean").alias("clean_rows"),
        (_raw_rows() - F.count_if("is_clean")).alias("removed_rows"),
        F.when(has_quantity, rejected).alias("rejected_quantity"),
    )


def cleaning_counts(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
) -> DataFrame:
    """Per feed: raw, clean and removed rows, and complete rows with a quantity
    of 0 or less (NULL for the feeds that have none). One pass over each feed.
    """
    feeds = ((customers, CUSTOMERS), (products, PRODUCTS), (orders, ORDERS))
    parts = [counted(audited(raw, rules, order_by, date_formats), rules) for raw, rules in feeds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quality_report(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = DATE_FORMATS,
    null_keys_match: bool = True,
) -> DataFrame:
    """The nine counters as one row.

    Every feed is read once: the deduplicated rows of a lookup serve its counts
    and the join (one shuffle, used twice), and those of the orders, clean or
    not, go through both joins with their flag to one aggregate.
    """

    def dimension_counts(side: DataFrame, rules: FeedRules) -> DataFrame:
        return side.agg(
            _raw_rows().alias(f"raw_{rules.feed}"),
            F.count_if("is_clean").alias(f"clean_{rules.feed}"),
        )

    def lookup(side: DataFrame, rules: FeedRules, flag: str) -> DataFrame:
        # Asking for the copies keeps both uses of the aggregate the same.
        found = side.where(F.col("is_clean") & (F.col("copies") > 0))
        return found.select(rules.key, F.lit(True).alias(flag))

    sides = {
        rules.feed: audited(raw, rules, order_by, date_formats)
        for raw, rules in ((customers, CUSTOMERS), (products, PRODUCTS))
    }
    judged = audited(orders, ORDERS, order_by, date_formats, ("customer_id", "product_id"))
    matched = judged.select("customer_id", "product_id", "copies", "is_clean")
    for rules, flag in ((CUSTOMERS, "has_customer"), (PRODUCTS, "has_product")):
        matched = attach(matched, lookup(sides[rules.feed], rules, flag), rules.key, null_keys_match)
    clean = F.col("is_clean")
    with_customer, with_product = F.col("has_customer").isNotNull(), F.col("has_product").isNotNull()
    order_counts = matched.agg(
        _raw_rows().alias("raw_orders"),
        F.count_if(clean).alias("clean_orders"),
        F.count_if(clean & ~with_customer).alias("missing_customers"),
        F.count_if(clean & ~with_product).alias("missing_products"),
        F.count_if(clean & with_customer & with_product).alias("valid_orders"),
    )
    parts = (
        dimension_counts(sides["customers"], CUSTOMERS)
        .unionByName(dimension_counts(sides["products"], PRODUCTS), allowMissingColumns=True)
        .unionByName(order_counts, allowMissingColumns=True)
    )
    return parts.agg(*(F.max(name).alias(name) for name in QUALITY_COUNTERS))


def removed_deltas(quality: DataFrame) -> DataFrame:
    """Rows removed from each feed, from a quality row."""
    return quality.select(
        *(
            (F.col(f"raw_{feed}") - F.col(f"clean_{feed}")).alias(f"removed_{feed}")
            for feed in ("customers", "products", "orders")
        )
    )


def cleaning_funnel(quality: DataFrame) -> DataFrame:
    """Seven (stage_number, stage, row_count) rows in order, from a quality row."""
    rows = ", ".join(
        f"{number}, '{stage}', {counter}"
        for number, (stage, counter) in enumerate(FUNNEL_STAGES, start=1)
    )
    return quality.selectExpr(
        f"stack({len(FUNNEL_STAGES)}, {rows}) AS (stage_number, stage, row_count)"
    )


def match_counters(quality: DataFrame) -> DataFrame:
    """Unmatched and valid counts, from a quality row."""
    return quality.select("missing_customers", "missing_products", "valid_orders")
