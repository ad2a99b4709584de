"""Relations between results that must hold on any data."""

import pytest
from pyspark.sql import functions as F

from checks.registry import sales
from ordermill.operators.filters import apply_filters, filter_domains
from ordermill.plans import batch, dashboard


@pytest.fixture(scope="module")
def everything(spark, medium):
    return sales(spark, medium, valid_only=False).persist()


@pytest.fixture(scope="module")
def valid(spark, medium):
    return sales(spark, medium, valid_only=True).persist()


def summed(report, column="revenue"):
    return round(report.agg(F.sum(column)).first()[0] or 0.0, 2)


def test_groups_add_up_to_the_total(valid):
    total = dashboard.kpis(valid).first().total_revenue
    assert summed(dashboard.monthly_revenue(valid)) == total
    lost = summed(valid.filter("category IS NULL"), "total_amount")
    for report in (dashboard.category_revenue, dashboard.heatmap_long, dashboard.heatmap_dense):
        assert summed(report(valid)) == round(total - lost, 2)
    bubble = dashboard.product_bubble(valid)
    assert summed(bubble, "orders") == valid.filter("category IS NOT NULL").count()


def test_matrix_and_long_form_agree(valid):
    wide = dashboard.heatmap_matrix(valid)
    months = wide.columns[1:]
    total = round(sum(sum(row[m] for m in months) for row in wide.collect()), 2)
    assert total == summed(dashboard.heatmap_dense(valid))
    assert dashboard.heatmap_dense(valid).count() == wide.count() * len(months)


def test_batch_and_dashboard_totals(everything, valid):
    orphans = everything.filter("customer_name IS NULL AND product_name IS NOT NULL")
    gap = summed(orphans, "total_amount")
    total = batch.total_revenue(everything).first()[0]
    assert round(total - gap, 2) == batch.total_revenue(valid).first()[0]


def test_filters_split_the_fact(valid):
    categories = [
        row.value for row in filter_domains(valid).filter("domain = 'category' AND position > 0").collect()
    ]
    parts = sum(apply_filters(valid, category=c).count() for c in categories)
    assert parts == valid.filter("category IS NOT NULL").count()


def test_histogram_counts_every_customer(valid):
    customers = dashboard.kpis(valid).first().unique_customers
    assert summed(dashboard.orders_histogram(valid), "customers") == customers
