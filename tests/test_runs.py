import re

import pytest
from helpers import customers, orders, products, values

from ordermill import run_batch, run_etl, runs
from ordermill.__main__ import main
from ordermill.plans import dashboard, quality
from ordermill.runs import stage_feeds, staged_sales
from ordermill.schema import DATE_FORMATS
from ordermill.sources import csv_feeds, store

FEEDS = {
    "customers.csv": """customer_id,customer_name,city,signup_date
C1,Ada,Lagos,2022-01-01
C1,Ada again,Kano,2022-01-02
C2,Bayo,Abuja,2022-02-30
C3,,Ibadan,2022-01-03
C4,"Chi, O.",Enugu,2022-01-04
""",
    "products.csv": """product_id,product_name,category,price
P1,Rice,Food,1500.5
P2,Soap,N/A,200
P3,Lamp,Home,free
""",
    "orders.csv": """order_id,customer_id,product_id,quantity,order_date
O1,C1,P1,2,2023-01-05
O2,C1,P2,3,2023-02-05
O3,C2,P1,1,2023-02-06
O4,C4,P3,1,2023-02-07
O5,C4,P1,0,2023-02-08
O6,C4,P1,x,2023-02-08
O7,C4,P1,4,2023-03-01
O7,C1,P1,9,2023-03-01
""",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FEEDS.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return tmp_path


def paths(folder):
    return [str(folder / name) for name in (*FEEDS, "sales")]


def test_batch_run(spark, folder):
    run = run_batch(spark, *paths(folder))
    details = {name: values(detail) for name, detail in run.details.items()}
    assert details["feed_profile"] == [("customers", 5, 4), ("products", 3, 4), ("orders", 8, 5)]
    assert details["first_orders"][0] == ("O1", "C1", "P1", "2", "2023-01-05")
    assert details["cleaning_counts"] == [
        ("customers", 5, 2, 3, None), ("products", 3, 2, 1, None), ("orders", 8, 5, 3, 1),
    ]
    assert details["load_check"] == [(5, 5, True)]
    assert details["match_counts"] == [(5, 1, 1, 3)]
    assert len(details["schema"]) == 12 and len(details["first_sales"]) == 5
    assert details["total_revenue"] == [(3001.0 + 600.0 + 1500.5 + 6002.0,)]
    assert details["top_customers"] == [
        (1, "C4", "Chi, O.", "Enugu", 6002.0), (2, "C1", "Ada", "Lagos", 3601.0),
    ]
    assert details["category_revenue_share"] == [("Food", 10503.5, 94.6)]
    assert [row[0] for row in details["monthly_trend"]] == ["2023-01", "2023-02", "2023-03"]
    assert dashboard.kpis(run.valid_sales).first().total_orders == 3


def with_dates(folder, change):
    for name in ("customers.csv", "orders.csv"):
        text = (folder / name).read_text(encoding="utf-8")
        (folder / name).write_text(re.sub(r"(\d{4})-(\d\d)-(\d\d)", change, text), encoding="utf-8")


@pytest.mark.parametrize("change", [r"\1/\2/\3", r"\2/\3/\1", r"\2.\3.\1", r"\1-\2-\3T10:00:00"])
def test_dates_of_other_shapes(spark, folder, change):
    plain = values(run_batch(spark, *paths(folder)).sales, "order_id", "year_month", "total_amount")
    with_dates(folder, change)
    other = run_batch(spark, *paths(folder))
    assert sorted(values(other.sales, "order_id", "year_month", "total_amount")) == sorted(plain)
    assert len(plain) == 5


def test_a_run_that_cannot_read_the_dates_keeps_the_old_fact(spark, folder):
    old = values(run_batch(spark, *paths(folder)).sales)
    with_dates(folder, r"\1\2\3")
    with pytest.raises(ValueError, match="no known date format in customers.signup_date"):
        run_batch(spark, *paths(folder))
    assert values(store.open_sales(spark, str(folder / "sales"))) == old
    again = run_batch(spark, *paths(folder), date_formats=["yyyyMMdd"])
    assert sorted(values(again.sales)) == sorted(old)
    mixed = {"customers": ["yyyyMMdd"], "orders": ["yyyyMMdd"]}
    assert sorted(values(run_batch(spark, *paths(folder), date_formats=mixed).sales)) == sorted(old)


def test_a_load_with_other_rows_than_meant_is_refused(spark, folder, monkeypatch):
    old = values(run_batch(spark, *paths(folder)).sales)
    monkeypatch.setattr(runs, "staged_sales", lambda staged: staged_sales(staged).limit(2))
    with pytest.raises(RuntimeError, match="differs from the clean orders"):
        run_batch(spark, *paths(folder))
    assert values(store.open_sales(spark, str(folder / "sales"))) == old


def test_each_feed_is_shuffled_once(spark, folder, tmp_path):
    names = dict(zip(("customers", "products", "orders"), paths(folder), strict=False))
    feeds = {name: csv_feeds.read_feed(spark, path, ()) for name, path in names.items()}
    exchanges = {}
    for rules in runs.FEEDS:
        judged = quality.audited(feeds[rules.feed], rules, carried=rules.columns)
        plan = judged._jdf.queryExecution().executedPlan().toString()
        exchanges[rules.feed] = plan.count("Exchange hashpartitioning")
    assert exchanges == {"customers": 1, "products": 1, "orders": 1}
    staged = stage_feeds(spark, feeds, DATE_FORMATS, str(tmp_path / "staged"))
    # The audit then needs no shuffle by key, and the fact only what its joins need.
    for rules in runs.FEEDS:
        plan = quality.counted(staged[rules.feed], rules)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "csv" not in plan.lower()
    plan = staged_sales(staged)._jdf.queryExecution().executedPlan().toString()
    assert "source_ordinal" not in plan and "csv" not in plan.lower()


def test_command_line(spark, folder, capsys):
    main([*paths(folder), "--flat", "--single-line-cells", "--date-format", "yyyy-MM-dd"])
    shown = capsys.readouterr().out
    assert "top_customers" in shown and "Chi, O." in shown
    assert not list((folder / "sales").rglob("year_month=*"))


def test_fact_and_quality(spark):
    sales, report = run_etl(
        customers(spark, ("c", "Cy", "Abuja")),
        products(spark, ("p", "Pen", "Office", "2")),
        orders(spark, ("o2", "c", "p", "2", "2023-02-05"), ("o1", "c", "p", "1", "2023-01-05"),
               ("o3", "x", "p", "1", "2023-01-05")),
        order_by="seq",
    )
    assert sorted(values(sales, "order_id", "total_amount")) == [("o1", 2.0), ("o2", 4.0)]
    for report_of in (dashboard.kpis, dashboard.product_bubble, dashboard.heatmap_long):
        plan = report_of(sales)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
    assert values(report) == [(1, 1, 1, 1, 3, 3, 1, 0, 2)]
