import pytest
from helpers import fact, values

from checks import registry
from ordermill.operators.filters import apply_filters
from ordermill.plans import dashboard
from ordermill.plans.sketches import distinct_sketches, sketched_counts

CHOICES = [
    {},
    {"category": "ECONOMY ANODIZED TIN"},
    {"city": "NATION_3"},
    {"months": ("1996-03", "1997-09")},
    {"city": "NATION_7", "months": ("1995-01", "1998-12")},
    {"category": "no such category"},
]


@pytest.fixture(scope="module")
def sales(spark, medium):
    return registry.sales(spark, medium, valid_only=True).persist()


@pytest.fixture(scope="module")
def sketches(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches") / "table")
    distinct_sketches(sales).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("choice", CHOICES, ids=str)
def test_estimates_are_close_under_any_filter(sales, sketches, choice):
    exact = dashboard.kpis(apply_filters(sales, **choice)).first()
    found = sketched_counts(apply_filters(sketches, **choice)).first()
    assert found.total_orders == exact.total_orders
    for name in ("unique_customers", "unique_products"):
        assert found[name] == pytest.approx(exact[name], rel=0.05)


def test_groups_and_missing_keys(spark):
    rows = [{"customer_id": f"c{n}", "product_id": None, "city": None if n < 10 else "A", "category": "k"} for n in range(30)]
    sketches = distinct_sketches(fact(spark, *rows, {"customer_id": None, "product_id": "p", "city": "A", "category": None}))
    assert values(sketched_counts(sketches, "city")) == [("A", 21, 20, 1)]
    assert values(sketched_counts(sketches)) == [(31, 30, 1)]
    assert values(sketched_counts(sketches.limit(0))) == [(0, 0, 0)]


def test_one_row_per_group_whatever_the_fact(sales, sketches):
    assert sketches.count() == sales.select("year_month", "category", "city").distinct().count()
