import pytest

from checks import registry
from ordermill.plans import quality

# Worked out apart from the library, see FIXTURES.md.
EXPECTED = {
    "sf0.001": {
        "raw_customers": 165, "clean_customers": 143, "raw_products": 220, "clean_products": 188,
        "raw_orders": 6000, "clean_orders": 3868, "missing_customers": 204,
        "missing_products": 261, "valid_orders": 3418,
    },
    "sf0.01": {
        "raw_customers": 1650, "clean_customers": 1432, "raw_products": 2200,
        "clean_products": 1877, "raw_orders": 60000, "clean_orders": 38787,
        "missing_customers": 2277, "missing_products": 3020, "valid_orders": 33646,
    },
    "sf0.1": {
        "raw_customers": 16500, "clean_customers": 14322, "raw_products": 22000,
        "clean_products": 18779, "raw_orders": 600000, "clean_orders": 387776,
        "missing_customers": 23064, "missing_products": 28697, "valid_orders": 337707,
    },
}
REJECTED = {"sf0.001": 386, "sf0.01": 3311, "sf0.1": 31648}


@pytest.mark.parametrize("scale", EXPECTED)
def test_counters(spark, small, scale):
    folder = small.replace("sf0.001", scale)
    report = registry.QUERIES["quality_report"](spark, folder)
    assert report.first().asDict() == EXPECTED[scale]
    counts = {row.feed: row for row in registry.QUERIES["cleaning_counts"](spark, folder).collect()}
    assert counts["orders"].rejected_quantity == REJECTED[scale]
    assert counts["customers"].rejected_quantity is None
    for feed, row in counts.items():
        assert row.raw_rows == EXPECTED[scale][f"raw_{feed}"]
        assert row.removed_rows == row.raw_rows - row.clean_rows


def test_funnel_follows_the_counters(spark, small):
    report = quality.quality_report(*registry.raw_feeds(spark, small), order_by="seq")
    funnel = quality.cleaning_funnel(report).orderBy("stage_number").collect()
    assert [row.row_count for row in funnel] == [165, 143, 220, 188, 6000, 3868, 3418]
    assert quality.removed_deltas(report).first().asDict() == {
        "removed_customers": 22, "removed_products": 32, "removed_orders": 2132,
    }


def test_empty_feeds(spark, small):
    empty = [feed.limit(0) for feed in registry.raw_feeds(spark, small)]
    report = quality.quality_report(*empty, order_by="seq").first().asDict()
    assert set(report.values()) == {0}
