"""Retail order analytics as Spark jobs: feeds in, sales fact and reports out."""

from ordermill.operators.filters import apply_filters, filter_domains, filter_values
from ordermill.runs import BatchRun, run_batch, run_etl
from ordermill.plans.sales import build_sales_summary, in_date_order, valid_sales
from ordermill.session import build_session, size_shuffles
from ordermill.sources.csv_feeds import read_customers, read_orders, read_products
from ordermill.sources.store import (
    export_csv,
    open_sales,
    save_sales,
    save_sales_jdbc,
    save_sales_table,
)

__all__ = [
    "BatchRun",
    "apply_filters",
    "build_sales_summary",
    "build_session",
    "export_csv",
    "filter_domains",
    "filter_values",
    "in_date_order",
    "open_sales",
    "read_customers",
    "read_orders",
    "read_products",
    "run_batch",
    "run_etl",
    "save_sales",
    "save_sales_jdbc",
    "save_sales_table",
    "size_shuffles",
    "valid_sales",
]
