"""Every operator as a named query over the star-schema tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.clean import (
    ORDERS,
    clean_customers,
    clean_orders,
    clean_products,
    typed_feed,
)
from ordermill.operators.dedup import keep_first, keep_first_counting
from ordermill.operators.filters import apply_filters, filter_domains
from ordermill.operators.match import match_counts
from ordermill.runs import run_batch
from ordermill.plans import batch, dashboard, profile, quality, sketches
from ordermill.plans.present import (
    BEST_PRODUCT_LABELS,
    CATEGORY_SHARE_LABELS,
    CUSTOMER_TABLE_LABELS,
    TOP_CUSTOMER_LABELS,
    present,
)
from ordermill.plans.sales import build_sales_summary, in_date_order, merged_orders
from ordermill.session import scratch_path, size_shuffles
from ordermill.sources import csv_feeds, star_tables, store
from ordermill.sources.star_tables import SEQ

Query = Callable[[SparkSession, str], DataFrame]

CATEGORY, CITY, MONTHS = "ECONOMY", "NATION_3", ("1996-03", "2000-09")
FEED_TABLES = ("customer", "nation", "part", "lineitem", "orders")


@lru_cache(maxsize=64)
def _sized(spark: SparkSession, folder: str) -> int:
    return size_shuffles(spark, *(f"{folder}/{name}.parquet" for name in FEED_TABLES))


def raw_feeds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    _sized(spark, folder)
    return star_tables.feeds(spark, folder)


def sales(spark: SparkSession, folder: str, valid_only: bool) -> DataFrame:
    return build_sales_summary(*raw_feeds(spark, folder), valid_only=valid_only, order_by=SEQ)


def _batch(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(sales(spark, folder, valid_only=False))


def _board(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(apply_filters(sales(spark, folder, valid_only=True)))


def _selected(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(
        apply_filters(sales(spark, folder, valid_only=True), CATEGORY, CITY, MONTHS)
    )


def _quality(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: view(
        quality.quality_report(*raw_feeds(spark, folder), order_by=SEQ)
    )


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    return merged_orders(*raw_feeds(spark, folder), order_by=SEQ)


def _typed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return typed_feed(raw_feeds(spark, folder)[2], ORDERS, SEQ)


def _feed_profile(spark: SparkSession, folder: str) -> DataFrame:
    named = dict(zip(("customers", "products", "orders"), raw_feeds(spark, folder), strict=True))
    return profile.feed_profile(named, order_by=SEQ)


def _stored(spark: SparkSession, folder: str, valid_only: bool = False) -> DataFrame:
    path = scratch_path(spark, "sales")
    store.save_sales(sales(spark, folder, valid_only=False), path)
    return store.open_sales(spark, path, valid_only)


def _load_count_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = clean_orders(raw_feeds(spark, folder)[2], SEQ)
    return store.verify_load(_stored(spark, folder), orders.agg(F.count("*")))


def _stored_schema(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sales")
    store.save_sales(sales(spark, folder, valid_only=False), path)
    return profile.schema_report(store.stored_columns(spark, path))


def _written_as(feed: DataFrame, shapes: dict[int, str]) -> DataFrame:
    """Orders whose dates are written in shapes by the length of the order id modulo 5; the rest month first."""
    day = F.try_to_date("order_date", "yyyy-MM-dd")
    turn = F.length("order_id") % 5
    written = F.date_format(day, "MM/dd/yyyy")
    for remainder, shape in shapes.items():
        written = F.when(turn == remainder, F.date_format(day, shape)).otherwise(written)
    return feed.withColumn("order_date", F.coalesce(written, F.col("order_date")))


def _clean_orders_inferred_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates month first, some without separators: those have no shape and are dropped."""
    feed = _written_as(raw_feeds(spark, folder)[2], {1: "yyyyMMdd"})
    return clean_orders(feed, SEQ, date_formats=None)


def _load_kept_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The stored fact after a load of its valid rows alone that its check refused."""
    path = scratch_path(spark, "sales")
    store.save_sales(sales(spark, folder, valid_only=False), path)

    def refuse(loaded: DataFrame) -> None:
        raise RuntimeError(f"{loaded.count()} rows are not all sales")

    with contextlib.suppress(RuntimeError):
        # The rows that are stored already serve the second load: nothing is cleaned and joined again.
        store.save_sales(store.open_sales(spark, path, valid_only=True), path, check=refuse)
    return store.open_sales(spark, path)


def _sketched_customers(valid: DataFrame) -> DataFrame:
    """Orders per city with the exact number of customers, and whether the sketched one is within a tenth of it."""
    sketched = sketches.sketched_counts(sketches.distinct_sketches(valid), "city")
    exact = valid.where("city is not null").groupBy("city").agg(F.count_distinct("customer_id").alias("customers"))
    near = F.abs(F.col("unique_customers") - F.col("customers")) <= F.col("customers") * 0.1
    return sketched.join(exact, "city").select("city", "total_orders", "customers", near.alias("close"))


def _catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    name = f"sales_summary_{uuid.uuid4().hex}"
    store.save_sales_table(sales(spark, folder, valid_only=False), name)
    return spark.table(name)


def _positions(frame: DataFrame, *keys: str) -> DataFrame:
    """The keys of a sorted frame with the place at which each row really comes out."""
    spark, path = frame.sparkSession, scratch_path(frame.sparkSession, "positions")
    place = F.monotonically_increasing_id()
    frame.select(*keys, place.alias("place")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").count()
    bases = parts.select("part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("base"))
    within = F.col("place") - F.shiftleft("part", 33)
    return rows.join(bases, "part").select(*keys, (F.col("base") + within + 1).alias("position"))


def _odd_names(spark: SparkSession, folder: str) -> DataFrame:
    """An export whose names are empty, padded, or hold line breaks and quotes, read back."""
    name, turn = F.col("customer_name"), F.length("order_id") % 5
    odd = (
        F.when(turn == 0, "").when(turn == 1, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(turn == 2, F.concat(name, F.lit('\nsaid "so", twice'))).when(turn == 3, name)
    )
    path = scratch_path(spark, "export")
    store.export_csv(sales(spark, folder, valid_only=True).withColumn("customer_name", odd), path)
    return store.read_csv_export(spark, path)


def _csv_export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "export")
    store.export_csv(sales(spark, folder, valid_only=True), path)
    return store.read_csv_export(spark, path)


def _csv_export_single_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "export") + ".csv"
    store.export_csv(sales(spark, folder, valid_only=True), path, single_file=True)
    return store.read_csv_export(spark, path)


def _as_csv(spark: SparkSession, feed: DataFrame, name: str) -> str:
    """The feed as CSV files that follow each other in its row order."""
    path = scratch_path(spark, f"{name}-feed")
    kind = feed.schema[SEQ].dataType
    # The fields of a struct one by one: the first then sorts by number, not by comparing rows.
    order = [f"{SEQ}.{field}" for field in kind.names] if isinstance(kind, T.StructType) else [SEQ]
    feed.orderBy(*order).drop(SEQ).write.option("header", True).csv(path)
    return path


def _csv_ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_csv(spark, raw_feeds(spark, folder)[2], "orders")
    return clean_orders(csv_feeds.read_orders(spark, path))


def _batch_run_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customers", "products", "orders")
    paths = [
        _as_csv(spark, feed, name)
        for name, feed in zip(names, raw_feeds(spark, folder), strict=True)
    ]
    return run_batch(spark, *paths, scratch_path(spark, "sales")).sales


def _currency_labels(valid: DataFrame) -> DataFrame:
    monthly = dashboard.monthly_orders(valid)
    return present(
        monthly.withColumn("revenue_whole", monthly.revenue),
        money=("revenue",),
        whole_money=("revenue_whole",),
        counts=("orders",),
    )


QUERIES: dict[str, Query] = {
    # feeds and cleaning
    "feed_profile": _feed_profile,
    "preview_raw_orders": lambda spark, folder: profile.preview_feed(
        raw_feeds(spark, folder)[2], 3, SEQ
    ),
    "dedup_orders_keep_first": lambda spark, folder: keep_first(
        _typed_orders(spark, folder), "order_id", SEQ
    ),
    "dedup_orders_counting": lambda spark, folder: keep_first_counting(
        _typed_orders(spark, folder), "order_id", SEQ
    ),
    "clean_customers": lambda spark, folder: clean_customers(raw_feeds(spark, folder)[0], SEQ),
    "clean_products": lambda spark, folder: clean_products(raw_feeds(spark, folder)[1], SEQ),
    "clean_orders": lambda spark, folder: clean_orders(raw_feeds(spark, folder)[2], SEQ),
    "clean_orders_inferred_dates": _clean_orders_inferred_dates,
    "cleaning_counts": lambda spark, folder: quality.cleaning_counts(
        *raw_feeds(spark, folder), order_by=SEQ
    ),
    # matching and the fact
    "merged_orders": _merged,
    "match_counts": lambda spark, folder: match_counts(_merged(spark, folder)),
    "sales_summary_all": lambda spark, folder: sales(spark, folder, valid_only=False),
    "sales_summary_valid": lambda spark, folder: sales(spark, folder, valid_only=True),
    "sales_in_date_order": lambda spark, folder: in_date_order(sales(spark, folder, True)),
    "preview_sales": _board(profile.preview_sales),
    # batch reports
    "total_revenue": _batch(batch.total_revenue),
    "top_customers_5": _batch(batch.top_customers),
    "top_customers_display": _batch(
        lambda s: present(batch.top_customers(s), TOP_CUSTOMER_LABELS, ("total_amount",))
    ),
    "best_products_5": _batch(batch.best_products),
    "best_products_display": _batch(
        lambda s: present(batch.best_products(s), BEST_PRODUCT_LABELS, ("revenue",))
    ),
    "category_revenue_share": _batch(batch.category_revenue_share),
    "category_share_display": _batch(
        lambda s: present(batch.category_revenue_share(s), CATEGORY_SHARE_LABELS, ("revenue",))
    ),
    "monthly_trend": _batch(batch.monthly_trend),
    "monthly_trend_lines": _batch(lambda s: batch.trend_lines(batch.monthly_trend(s))),
    "average_order_value": _batch(batch.average_order_value),
    "run_summary": _batch(batch.run_summary),
    # filters
    "filter_domains": lambda spark, folder: filter_domains(sales(spark, folder, True)),
    "filtered_sales": _selected(lambda s: s),
    # dashboard reports
    "kpis": _board(dashboard.kpis),
    "kpis_filtered": _selected(dashboard.kpis),
    "monthly_revenue": _board(dashboard.monthly_revenue),
    "category_revenue": _board(dashboard.category_revenue),
    "top_cities": _board(dashboard.top_cities),
    "category_revenue_asc": _board(dashboard.category_revenue_ascending),
    "monthly_orders": _board(dashboard.monthly_orders),
    "monthly_orders_filtered": _selected(dashboard.monthly_orders),
    "monthly_avg_order": _board(dashboard.monthly_average),
    "revenue_heatmap_long": _board(dashboard.heatmap_long),
    "revenue_heatmap_dense": _board(dashboard.heatmap_dense),
    "revenue_heatmap_matrix": _board(dashboard.heatmap_matrix),
    "top_products_units": _board(dashboard.top_products_by_units),
    "top_products_revenue": _board(dashboard.top_products_by_revenue),
    "product_bubble": _board(dashboard.product_bubble),
    "product_table": _board(dashboard.product_table),
    "product_table_display": _board(
        lambda s: present(dashboard.product_table(s), money=("revenue",))
    ),
    "top_customers_10": _board(dashboard.top_spenders),
    "orders_per_customer": _board(dashboard.orders_per_customer),
    "orders_histogram": _board(dashboard.orders_histogram),
    "customers_by_city": _board(dashboard.customers_by_city),
    "avg_spend_by_city": _board(dashboard.average_spend_by_city),
    "customer_table_50": _board(dashboard.customer_table),
    "customer_table_display": _board(
        lambda s: present(
            dashboard.customer_table(s), CUSTOMER_TABLE_LABELS, ("total_spent", "avg_order")
        )
    ),
    "currency_labels": _board(_currency_labels),
    "sketched_customers": _board(_sketched_customers),
    # order of rows
    "sales_date_positions": lambda spark, folder: _positions(
        in_date_order(sales(spark, folder, True)), "order_id"
    ),
    "monthly_revenue_positions": _board(
        lambda s: _positions(dashboard.monthly_revenue(s), "year_month")
    ),
    "product_table_positions": _board(
        lambda s: _positions(dashboard.product_table(s), "product_id", "product_name", "category")
    ),
    # quality
    "quality_report": _quality(lambda q: q),
    "removed_deltas": _quality(quality.removed_deltas),
    "cleaning_funnel": _quality(quality.cleaning_funnel),
    "quality_match_counts": _quality(quality.match_counters),
    # storing
    "load_roundtrip": _stored,
    "load_roundtrip_valid": lambda spark, folder: _stored(spark, folder, valid_only=True),
    "load_count_check": _load_count_check,
    "load_kept_after_failure": _load_kept_after_failure,
    "schema_report": _stored_schema,
    "catalog_table": _catalog_table,
    "catalog_table_schema": lambda spark, folder: profile.schema_report(_catalog_table(spark, folder)),
    "csv_export_odd_names": _odd_names,
    "csv_export_single_file": _csv_export_single_file,
    "csv_export_roundtrip": _csv_export_roundtrip,
    "csv_ingest_roundtrip": _csv_ingest_roundtrip,
    "batch_run_from_csv": _batch_run_from_csv,
}
