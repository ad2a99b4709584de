"""The two ways to run everything: one batch job, or fact plus quality row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators.clean import (
    CUSTOMERS,
    ORDERS,
    PRODUCTS,
    DateFormats,
    infer_date_formats,
)
from ordermill.operators.match import match_counts, match_orders
from ordermill.plans import batch, profile, quality
from ordermill.plans.sales import build_sales_summary, sales_of
from ordermill.schema import SOURCE_ORDINAL
from ordermill.session import drop_folder, scratch_path, size_shuffles
from ordermill.sources import csv_feeds, store

BATCH_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "total_revenue": batch.total_revenue,
    "top_customers": batch.top_customers,
    "best_products": batch.best_products,
    "category_revenue_share": batch.category_revenue_share,
    "monthly_trend": batch.monthly_trend,
    "average_order_value": batch.average_order_value,
    "run_summary": batch.run_summary,
}

FEEDS = (CUSTOMERS, PRODUCTS, ORDERS)


def run_etl(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    order_by: str = SOURCE_ORDINAL,
    date_formats: DateFormats = None,
) -> tuple[DataFrame, DataFrame]:
    """Valid sales, unsorted, and the quality row of three raw feeds.

    Without ``date_formats`` the first rows of the feeds are fetched to see how
    their dates are written; dates of no known format only are an error. Sort for showing or exporting only (``in_date_order``, ``preview_sales``,
    ``export_csv``): a report would carry the sort along.
    """
    feeds = (customers, products, orders)
    if date_formats is None:
        date_formats = {
            rules.feed: infer_date_formats(raw, rules, order_by, strict=True)
            for rules, raw in zip(FEEDS, feeds, strict=True)
        }
    sales = build_sales_summary(
        *feeds, valid_only=True, order_by=order_by, date_formats=date_formats
    )
    report = quality.quality_report(*feeds, order_by=order_by, date_formats=date_formats)
    return sales, report


@dataclass(frozen=True)
class BatchRun:
    """The stored fact, its valid rows and what a run tells about it."""

    sales: DataFrame
    valid_sales: DataFrame
    details: dict[str, DataFrame] = field(default_factory=dict)


def stage_feeds(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    date_formats: DateFormats,
    folder: str,
) -> dict[str, DataFrame]:
    """The feeds typed, deduplicated and judged, written once for all who read them.

    A feed goes through one shuffle, by its key; the fact and the audit both
    read what is left: a row for each key, with its copies and its verdict.
    """
    staged = {}
    for rules in FEEDS:
        path = f"{folder}/{rules.feed}"
        judged = quality.audited(
            feeds[rules.feed], rules, date_formats=date_formats, carried=rules.columns
        )
        judged.write.parquet(path)
        staged[rules.feed] = spark.read.schema(judged.schema).parquet(path)
    return staged


def staged_sales(staged: Mapping[str, DataFrame]) -> DataFrame:
    """The sales fact of staged feeds, with unmatched orders."""
    clean = {rules: staged[rules.feed].where("is_clean").select(*rules.columns) for rules in FEEDS}
    return sales_of(match_orders(clean[ORDERS], clean[CUSTOMERS], clean[PRODUCTS]))


def run_batch(
    spark: SparkSession,
    customers_path: str,
    products_path: str,
    orders_path: str,
    target: str,
    by_month: bool = True,
    date_formats: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
    **read_options,
) -> BatchRun:
    """Read three CSV feeds, store the fact at ``target``, report on what is stored.

    The fact keeps unmatched orders. Reports are lazy and read the stored columns
    they need. The feeds are read twice, for line breaks in cells and to be
    staged; besides, their first files for the first rows, which also tell how dates
    are written if ``date_formats`` does not. What is staged serves the fact, the profile, the
    cleaning counts and the check of the load, and goes when those are done.

    The new fact takes the old one's place only once its rows are as many as the clean
    orders and its cells are those that were meant; else this raises.
    """
    sources = {
        rules.feed: (path, rules.columns)
        for rules, path in zip(FEEDS, (customers_path, products_path, orders_path), strict=True)
    }
    size_shuffles(spark, *(path for path, _ in sources.values()), kind="csv")
    feeds = {
        name: csv_feeds.read_feed(spark, *source, **read_options)
        for name, source in sources.items()
    }

    def first_rows(name: str, n: int) -> DataFrame:
        return csv_feeds.head_of_feed(spark, *sources[name], n, **read_options)

    stated = date_formats if isinstance(date_formats, Mapping) else {}
    if date_formats is None or stated:
        date_formats = {
            rules.feed: stated.get(rules.feed)
            or infer_date_formats(
                feeds[rules.feed], rules, first_rows=partial(first_rows, rules.feed), strict=True
            )
            for rules in FEEDS
        }
    folder = scratch_path(spark, "staged-feeds")
    staged = stage_feeds(spark, feeds, date_formats, folder)
    counts = reduce(
        DataFrame.unionByName, (quality.counted(staged[rules.feed], rules) for rules in FEEDS)
    )
    # One row for each of the three feeds.
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    meant = counts.where("feed = 'orders'").select("clean_rows")

    def as_many(loaded: DataFrame) -> None:
        found = store.verify_load(loaded, meant).first()
        if not found.matches:
            raise RuntimeError(f"the load at {target} differs from the clean orders: {found}")

    store.save_sales(staged_sales(staged), target, by_month, check=as_many)
    drop_folder(spark, folder)
    stored = store.open_sales(spark, target)
    details = {
        "feed_profile": profile.counted_profile(counts, feeds),
        **{f"first_{name}": first_rows(name, 3) for name in sources},
        "cleaning_counts": counts,
        "load_check": store.verify_load(stored, meant),
        "match_counts": match_counts(stored),
        "first_sales": profile.preview_sales(stored, 5),
        "schema": profile.schema_report(store.stored_columns(spark, target)),
        **{name: report(stored) for name, report in BATCH_REPORTS.items()},
    }
    return BatchRun(stored, store.open_sales(spark, target, valid_only=True), details)
