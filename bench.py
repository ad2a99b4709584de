"""Headline timings: build and store the fact, then every report on it.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS.
Prints one JSON line. Each query counts with the fastest of its runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ordermill.operators.filters import apply_filters, filter_domains  # noqa: E402
from ordermill.plans import batch, dashboard, quality  # noqa: E402
from ordermill.plans.sales import build_sales_summary  # noqa: E402
from ordermill.runs import run_batch  # noqa: E402
from ordermill.session import build_session, scratch_path, size_shuffles  # noqa: E402
from ordermill.sources import star_tables, store  # noqa: E402
from ordermill.sources.star_tables import SEQ  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

BATCH_REPORTS = {
    "total_revenue": batch.total_revenue,
    "top_customers_5": batch.top_customers,
    "best_products_5": batch.best_products,
    "category_revenue_share": batch.category_revenue_share,
    "monthly_trend": batch.monthly_trend,
    "average_order_value": batch.average_order_value,
    "run_summary": batch.run_summary,
}
DASHBOARD_REPORTS = {
    "filter_domains": filter_domains,
    "kpis": dashboard.kpis,
    "monthly_revenue": dashboard.monthly_revenue,
    "category_revenue": dashboard.category_revenue,
    "top_cities": dashboard.top_cities,
    "category_revenue_asc": dashboard.category_revenue_ascending,
    "monthly_orders": dashboard.monthly_orders,
    "monthly_avg_order": dashboard.monthly_average,
    "revenue_heatmap_dense": dashboard.heatmap_dense,
    "revenue_heatmap_matrix": dashboard.heatmap_matrix,
    "top_products_units": dashboard.top_products_by_units,
    "top_products_revenue": dashboard.top_products_by_revenue,
    "product_bubble": dashboard.product_bubble,
    "product_table": dashboard.product_table,
    "top_customers_10": dashboard.top_spenders,
    "orders_histogram": dashboard.orders_histogram,
    "customers_by_city": dashboard.customers_by_city,
    "avg_spend_by_city": dashboard.average_spend_by_city,
    "customer_table_50": dashboard.customer_table,
}


def fastest(run) -> float:
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def main() -> None:
    spark = build_session(
        "ordermill-bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    size_shuffles(spark, f"{SF_DIR}/*.parquet")
    feeds = star_tables.feeds(spark, SF_DIR)
    path = scratch_path(spark, "bench-sales")

    timings = {
        "fact_build_and_store": fastest(
            lambda: store.save_sales(
                build_sales_summary(*feeds, valid_only=False, order_by=SEQ), path
            )
        ),
        "quality_report": fastest(
            lambda: quality.quality_report(*feeds, order_by=SEQ).collect()
        ),
    }
    # The path from CSV files to the stored and checked fact; the files are written untimed.
    folders = [scratch_path(spark, f"bench-{name}") for name in ("customers", "products", "orders", "csv-sales")]
    for feed, folder in zip(feeds, folders, strict=False):
        feed.orderBy(SEQ).drop(SEQ).write.option("header", True).csv(folder)
    from_csv = fastest(lambda: run_batch(spark, *folders))
    everything = store.open_sales(spark, path)
    stored_valid = store.open_sales(spark, path, valid_only=True)
    valid = apply_filters(stored_valid)
    year = apply_filters(stored_valid, months=("1997-01", "1997-12"))
    for name, report in BATCH_REPORTS.items():
        timings[name] = fastest(lambda report=report: report(everything).collect())
    for name, report in DASHBOARD_REPORTS.items():
        timings[name] = fastest(lambda report=report: report(valid).collect())
    timings["kpis_one_year"] = fastest(lambda: dashboard.kpis(year).collect())
    for folder in (path, *folders):
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "fact build plus all reports",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                # The CSV run is timed beside the metric, which stays what it was.
                "queries": {**timings, "batch_run_from_csv": from_csv},
                "sf": SF_DIR.rsplit("/sf", 1)[-1],
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
