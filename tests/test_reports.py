from datetime import datetime

import pytest
from helpers import fact, values

from ordermill.operators.filters import apply_filters, filter_domains, filter_values
from ordermill.plans import batch, dashboard
from ordermill.plans.present import TOP_CUSTOMER_LABELS, present


def line(customer="c", product="p", category="k", city="y", units=1.0, amount=1.0, month=1, **more):
    return {
        "customer_id": customer,
        "customer_name": None if customer is None else customer.upper(),
        "city": city,
        "product_id": product,
        "product_name": None if product is None else product.upper(),
        "category": category,
        "quantity": units,
        "price": 1.0,
        "total_amount": amount,
        "order_date": datetime(2023, month, 5),
        **more,
    }


def test_null_keys_are_no_group(spark):
    sales = fact(spark, line(category="a"), line(category=None), line(category="b"))
    assert values(dashboard.category_revenue(sales), "category") == [("a",), ("b",)]
    assert values(batch.top_customers(fact(spark, line(city=None)))) == []


def test_share_is_of_all_rows(spark):
    sales = fact(
        spark,
        line(category="a", amount=1.0),
        line(category="b", amount=None),
        line(category=None, amount=2.0),
    )
    assert values(batch.category_revenue_share(sales)) == [("a", 1.0, 33.3), ("b", 0.0, 0.0)]
    assert values(dashboard.category_revenue(sales)) == [("a", 1.0, 100.0), ("b", 0.0, 0.0)]


def test_months_without_priced_orders_show_zero(spark):
    sales = fact(spark, line(month=1, amount=None), line(month=2, amount=4.0), line(month=3, amount=1.0))
    trend = batch.monthly_trend(sales)
    assert values(trend) == [
        ("2023-01", 0.0, ""), ("2023-02", 4.0, "█" * 30), ("2023-03", 1.0, "█" * 7),
    ]
    assert values(batch.trend_lines(trend), "line")[2][0] == f"  2023-03  {'█' * 7:<32}  ₦{1:>14,.2f}"


def test_top_lists_break_ties_by_key(spark):
    sales = fact(spark, *(line(customer=f"c{n}", amount=5.0) for n in range(8)))
    assert values(batch.top_customers(sales, 3), "rank", "customer_id") == [
        (1, "c0"), (2, "c1"), (3, "c2"),
    ]
    assert values(dashboard.top_spenders(sales, 3), "customer_id") == [("c2",), ("c1",), ("c0",)]


def test_products_group_by_name_or_by_id(spark):
    rows = [line(product=p, product_name="Pen", units=2.0) for p in ("p1", "p2")]
    sales = fact(spark, *rows)
    assert values(dashboard.top_products_by_units(sales)) == [("Pen", "k", 4.0)]
    assert len(values(dashboard.product_table(sales))) == 2


def test_heatmaps_fill_gaps(spark):
    sales = fact(
        spark,
        line(category="a", month=1, amount=1.5),
        line(category="b", month=2, amount=2.0),
        line(category=None, month=3),
    )
    assert values(dashboard.heatmap_dense(sales)) == [
        ("a", "2023-01", 1.5), ("a", "2023-02", 0.0), ("b", "2023-01", 0.0), ("b", "2023-02", 2.0),
    ]
    matrix = dashboard.heatmap_matrix(sales)
    assert matrix.columns == ["category", "2023-01", "2023-02"]
    assert values(matrix) == [("a", 1.5, 0.0), ("b", 0.0, 2.0)]


@pytest.mark.parametrize("largest", [1, 19, 20, 21, 47])
def test_histogram_holds_every_customer_once(spark, largest):
    rows = [line(customer=f"c{n}") for n in range(1, largest + 1) for _ in range(n)]
    bins = values(dashboard.orders_histogram(fact(spark, *rows)))
    assert len(bins) <= 20
    assert sum(row[3] for row in bins) == largest
    width = -(-largest // 20)
    for _, start, end, count in bins:
        assert end - start + 1 == width
        assert count == len(range(start, min(end, largest) + 1))


def test_distinct_customers_by_city(spark):
    rows = [line(customer=c, city=y) for c, y in ["ax", "ax", "bx", "cz", (None, "z")]]
    sales = fact(spark, *rows)
    assert values(dashboard.customers_by_city(sales)) == [("z", 1), ("x", 2)]
    assert values(dashboard.customers_by_city(sales, approximate=True)) == [("z", 1), ("x", 2)]


def test_average_spend_skips_cities_without_amounts(spark):
    sales = fact(spark, line(city="x", amount=None), line(city="z", amount=2.0), line(city="z", amount=3.0))
    assert values(dashboard.average_spend_by_city(sales)) == [("z", 2.5)]


def test_run_summary(spark):
    sales = fact(
        spark, line(customer=None, amount=None, month=3), line(amount=2.0), line(amount=3.0, product="q")
    )
    row = batch.run_summary(sales).first().asDict()
    assert (row["total_orders"], row["total_revenue"], row["average_order_value"]) == (3, 5.0, 2.5)
    assert (row["unique_customers"], row["unique_products"]) == (1, 2)
    assert (str(row["first_date"]), str(row["last_date"])) == ("2023-01-05", "2023-03-05")


def test_filters(spark):
    sales = fact(
        spark,
        *(
            line(category=k, city=y, month=m)
            for k, y, m in [("a", "x", 1), ("a", "z", 2), ("b", "x", 3), ("a", "x", 4)]
        ),
    )
    count = lambda *args: apply_filters(sales, *args).count()
    assert count() == 4
    assert count("All", "All") == 4
    assert count("a") == 3
    assert count("a", "x") == 2
    assert count("a", "x", ("2023-01", "2023-03")) == 1
    assert count(None, None, ("2023-02", None)) == 3
    assert count(None, None, (None, "2023-02")) == 2
    assert values(filter_values(sales, "city")) == [("x",), ("z",)]
    assert values(filter_domains(sales))[:6] == [
        ("category", 0, "All"), ("category", 1, "a"), ("category", 2, "b"),
        ("city", 0, "All"), ("city", 1, "x"), ("city", 2, "z"),
    ]


def test_an_empty_selection(spark):
    empty = apply_filters(fact(spark, line()), city="nowhere")
    assert values(dashboard.kpis(empty)) == [(0.0, 0, 0, 0, 0.0, 0.0)]
    for report in (
        dashboard.monthly_revenue, dashboard.category_revenue, dashboard.top_cities,
        dashboard.category_revenue_ascending, dashboard.monthly_orders, dashboard.monthly_average,
        dashboard.heatmap_long, dashboard.heatmap_dense, dashboard.heatmap_matrix,
        dashboard.top_products_by_units, dashboard.top_products_by_revenue,
        dashboard.product_bubble, dashboard.product_table, dashboard.top_spenders,
        dashboard.orders_per_customer, dashboard.orders_histogram, dashboard.customers_by_city,
        dashboard.average_spend_by_city, dashboard.customer_table,
    ):
        assert values(report(empty)) == []


def test_display_form(spark):
    shown = present(batch.top_customers(fact(spark, line(amount=1234.5))), TOP_CUSTOMER_LABELS, ("total_amount",))
    assert shown.columns == ["rank", "ID", "Name", "City", "Total Spent"]
    assert values(shown) == [(1, "c", "C", "y", "₦1,234.50")]
