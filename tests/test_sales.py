from datetime import datetime

from helpers import customers, orders, products, values

from ordermill.operators.match import attach, match_counts
from ordermill.plans.sales import (
    build_sales_summary,
    in_date_order,
    merged_orders,
    valid_sales,
)
from ordermill.schema import SALES_SCHEMA


def feeds(spark):
    return (
        customers(spark, ("c", "Cy", "Abuja"), (None, "Nil", None)),
        products(spark, ("p", "Pen", "Office", "1.005")),
        orders(
            spark,
            ("o1", "c", "p", "2", "2023-02-05"),
            ("o2", "gone", "p", "1", "2023-01-05"),
            ("o3", "c", "gone", "3", "2023-01-04"),
            ("o4", None, "p", "1", "2023-01-03"),
        ),
    )


def test_null_keys_match(spark):
    left = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    by_key = lambda rows: sorted(rows, key=str)
    assert by_key(values(attach(left, right, "k"))) == by_key([("a", 2), (None, 1), ("b", None)])
    plain = attach(left, right, "k", null_keys_match=False)
    assert by_key(values(plain)) == by_key([("a", 2), (None, None), ("b", None)])


def test_unmatched_orders_stay_or_go(spark):
    raw = feeds(spark)
    everything = build_sales_summary(*raw, order_by="seq")
    assert sorted(values(everything, "order_id", "customer_name", "product_name", "total_amount")) == [
        ("o1", "Cy", "Pen", 2.01),
        ("o2", None, "Pen", 1.0),
        ("o3", "Cy", None, None),
        ("o4", "Nil", "Pen", 1.0),
    ]
    valid = build_sales_summary(*raw, valid_only=True, order_by="seq")
    assert sorted(values(valid, "order_id")) == [("o1",), ("o4",)]
    assert sorted(values(valid_sales(everything))) == sorted(values(valid))


def test_the_twelve_columns(spark):
    for valid_only in (False, True):
        sales = build_sales_summary(*feeds(spark), valid_only=valid_only, order_by="seq")
        assert [(f.name, f.dataType) for f in sales.schema] == [
            (f.name, f.dataType) for f in SALES_SCHEMA
        ]


def test_date_order(spark):
    sales = in_date_order(build_sales_summary(*feeds(spark), order_by="seq"))
    assert values(sales, "order_id", "year_month") == [
        ("o4", "2023-01"), ("o3", "2023-01"), ("o2", "2023-01"), ("o1", "2023-02"),
    ]
    assert sales.first().order_date == datetime(2023, 1, 3)


def test_match_counts(spark):
    counts = match_counts(merged_orders(*feeds(spark), order_by="seq"))
    assert counts.first().asDict() == {
        "merged_rows": 4, "missing_customers": 1, "missing_products": 1, "valid_orders": 2,
    }
