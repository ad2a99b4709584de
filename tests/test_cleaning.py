import math
from datetime import datetime

import pytest
from helpers import customers, orders, products, values

from ordermill.operators.clean import clean_customers, clean_orders, clean_products
from ordermill.operators.dedup import keep_first, keep_first_counting


def test_a_bad_first_copy_takes_the_good_ones_with_it(spark):
    feed = customers(spark, ("a", None, "X"), ("a", "Ann", "X"), ("b", "Bob", "Y"))
    assert values(clean_customers(feed, "seq"), "customer_id") == [("b",)]


def test_the_first_copy_is_kept_whatever_the_row_order(spark):
    rows = [("k", f"name{n}", "X", "2022-01-01", n) for n in range(50)]
    feed = customers(spark, *reversed(rows)).repartition(7)
    assert values(clean_customers(feed, "seq"), "customer_name") == [("name0",)]


def test_null_keys_are_one_group(spark):
    feed = customers(spark, (None, "n1", "X"), (None, "n2", "X"), ("a", "a1", "X"), ("a", "a2", "X"))
    kept = values(clean_customers(feed, "seq"), "customer_id", "customer_name")
    assert sorted(kept, key=str) == [("a", "a1"), (None, "n1")]


def test_both_forms_of_keep_first_agree(spark):
    feed = orders(
        spark, ("a", "1", "p", "1", "d"), (None, "2", "p", "2", "d"), ("a", "3", "p", "3", "d"),
        (None, "4", "p", "4", "d"), ("b", "5", "p", None, None),
    )
    plain = keep_first(feed, "order_id", "seq")
    counting = keep_first_counting(feed, "order_id", "seq")
    assert sorted(values(plain), key=str) == sorted(values(counting.drop("copies")), key=str)
    assert sorted(values(counting, "order_id", "copies"), key=str) == [
        ("a", 2), ("b", 1), (None, 2),
    ]


def test_customer_rules(spark):
    feed = customers(
        spark,
        ("good", "G", None, "2022-3-4", 1),
        ("no name", None, "X", "2022-01-01", 2),
        ("bad date", "B", "X", "2023-13-01", 3),
        ("no date", "N", "X", None, 4),
    )
    assert values(clean_customers(feed, "seq")) == [("good", "G", None, datetime(2022, 3, 4))]


def test_product_rules(spark):
    feed = products(
        spark,
        ("good", "G", None, "1e1"),
        ("negative", "N", "c", "-2"),
        ("no name", None, "c", "1"),
        ("bad price", "B", "c", "n/a"),
        ("nan price", "B", "c", "nan"),
        ("no price", "B", "c", None),
    )
    assert sorted(values(clean_products(feed, "seq"))) == [
        ("good", "G", None, 10.0),
        ("negative", "N", "c", -2.0),
    ]


def test_order_rules(spark):
    day = "2023-01-05"
    cells = ["nan", "NaN", "inf", "5", "0", "-3", "bad", None, "0.5"]
    feed = orders(
        spark,
        *((f"q{n}", "c", "p", cell, day) for n, cell in enumerate(cells)),
        ("bad date", "c", "p", "1", "2023-13-01"),
        ("no keys", None, None, "1", day),
    )
    assert sorted(values(clean_orders(feed, "seq"), "order_id", "quantity")) == [
        ("no keys", 1.0), ("q2", math.inf), ("q3", 5.0), ("q8", 0.5),
    ]


def test_missing_columns_are_named(spark):
    feed = customers(spark, ("a", "A", "X")).drop("city", "signup_date")
    with pytest.raises(ValueError, match="customers feed lacks .*city, signup_date"):
        clean_customers(feed, "seq")


def test_typed_feeds_need_no_text(spark):
    feed = spark.sql(
        "SELECT 1 AS order_id, 2 AS customer_id, 3 AS product_id, 4 AS quantity, "
        "DATE'2023-01-05' AS order_date, 0 AS seq"
    )
    assert values(clean_orders(feed, "seq")) == [("1", "2", "3", 4.0, datetime(2023, 1, 5))]
