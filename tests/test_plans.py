"""Shape of the physical plans, and behaviour under hot keys."""

import time

import pytest
from helpers import fact, values
from pyspark.sql import functions as F

from checks.registry import QUERIES, raw_feeds, sales
from ordermill.operators.clean import clean_orders
from ordermill.operators.dedup import keep_first, keep_first_counting
from ordermill.operators.match import attach, match_orders
from ordermill.plans import dashboard
from ordermill.plans.sales import build_sales_summary
from ordermill.sources import store

TOP_LISTS = {
    "top_customers_5", "best_products_5", "top_cities", "top_products_units",
    "top_products_revenue", "top_customers_10", "customers_by_city", "avg_spend_by_city",
    "customer_table_50", "preview_sales",
}
WRITERS = {
    "load_roundtrip", "load_roundtrip_valid", "load_count_check", "schema_report", "csv_export_roundtrip",
    "csv_ingest_roundtrip", "batch_run_from_csv", "catalog_table", "catalog_table_schema", "csv_export_odd_names",
    "sales_date_positions", "monthly_revenue_positions", "product_table_positions",
}


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_join_and_no_python(spark, small, name):
    plan = planned(QUERIES[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert word not in plan
    if name in TOP_LISTS:
        assert "TakeOrderedAndProject" in plan


def test_deduplication_cuts_copies_before_the_shuffle(spark, small):
    plan = planned(clean_orders(raw_feeds(spark, small)[2], "seq"))
    final, shuffle, partial = (
        plan.index("row_number(), 1, Final"),
        plan.index("Exchange hashpartitioning(order_id"),
        plan.index("row_number(), 1, Partial"),
    )
    assert final < shuffle < partial


def test_the_audit_reads_each_feed_once(spark, small, final_plan):
    from ordermill.plans.quality import quality_report

    plan = final_plan(quality_report(*raw_feeds(spark, small), order_by="seq"))
    used = plan.split("== Initial Plan ==")[0].splitlines()
    for key in ("customer_id", "product_id"):
        shuffles = [line for line in used if f"Exchange hashpartitioning({key}" in line]
        assert [("ReusedExchange" in line) for line in shuffles].count(False) == 1, shuffles
        assert len(shuffles) == 2, shuffles


def test_dense_heatmap_grows_with_its_cells(spark):
    months = [f"{1900 + n // 12}-{n % 12 + 1:02d}" for n in range(24)]
    taken = {}
    for categories in (1000, 1000, 2000):
        rows = spark.range(categories * 24).selectExpr(
            f"concat('c', id % {categories}) AS category",
            f"array({', '.join(repr(m) for m in months)})[cast(id DIV {categories} AS int)] AS year_month",
            "1.0D AS total_amount",
        )
        begun = time.perf_counter()
        assert dashboard.heatmap_dense(rows).count() == categories * 24
        taken[categories] = time.perf_counter() - begun
    assert taken[2000] < 4 * taken[1000] + 1
    with pytest.raises(ValueError, match="months"):
        dashboard.heatmap_matrix(fact(spark), [str(n) for n in range(2000)])


def test_filters_wait_for_the_deduplication(spark, small):
    plan = planned(clean_orders(raw_feeds(spark, small)[2], "seq"))
    assert plan.index("> 0.0") < plan.index("WindowGroupLimit")
    assert "> 0.0" not in plan[plan.index("WindowGroupLimit") :]


def test_valid_only_makes_inner_joins(spark, small):
    plan = planned(sales(spark, small, valid_only=True))
    joined = plan[: plan.index("WindowGroupLimit")]
    assert joined.count(", Inner,") == 2 and "LeftOuter" not in joined


def test_reports_read_only_their_columns(spark, small, tmp_path):
    path = str(tmp_path / "sales")
    store.save_sales(sales(spark, small, valid_only=False), path)
    plan = planned(dashboard.top_cities(store.open_sales(spark, path, valid_only=True)))
    assert "ReadSchema: struct<city:string,total_amount:double>" in plan
    assert "IsNotNull(city)" in plan


def shuffle_everything(with_conf):
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__shuffle__partitions="32",
    )


def hot_orders(spark, folder):
    """Real orders, a third of them moved to one customer and one to no customer."""
    clean = clean_orders(raw_feeds(spark, folder)[2], "seq")
    turn = F.abs(F.hash("order_id")) % 3
    hot = F.when(turn == 0, F.lit("C1")).when(turn == 1, F.col("customer_id"))
    return clean.withColumn("customer_id", hot)


def test_hot_join_keys_are_split(spark, medium, with_conf, final_plan):
    from ordermill.operators.clean import clean_customers, clean_products

    customers, products, _ = raw_feeds(spark, medium)
    orders = hot_orders(spark, medium)
    lookups = clean_customers(customers, "seq"), clean_products(products, "seq")

    def counts():
        matched = match_orders(orders, *lookups)
        return values(matched.groupBy("is_valid").count().orderBy("is_valid"))

    plain = counts()
    shuffle_everything(with_conf)
    joined = attach(orders, lookups[0].select("customer_id", "customer_name"), "customer_id")
    plan = final_plan(joined.select("order_id", "customer_name"))
    assert "skew=true" in plan
    assert counts() == plain


def test_a_hot_dedup_key_sends_one_row_per_task(spark, final_plan):
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
        (-F.col("id")).alias("seq"),
    )
    kept = keep_first(rows, "k", "seq")
    kept.collect()
    counted = keep_first_counting(rows, "k", "seq")
    assert values(counted.filter("k = 'hot'")) == [("hot", 29_997, 10_000)]
    assert values(kept.filter("k = 'hot'")) == [("hot", 29_997)]
    # Twenty thousand single keys and one row of the hot key from each task.
    metrics = _shuffled_rows(kept)
    assert metrics == 20_000 + 6


def _shuffled_rows(frame):
    """Rows the first shuffle of a run frame wrote."""
    plan = frame._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            return node.metrics().apply("shuffleRecordsWritten").value()
        if node.nodeName().startswith("ShuffleQueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no shuffle")


@pytest.mark.parametrize("partitions", ["1", "100"])
def test_results_do_not_depend_on_partitions(spark, small, with_conf, partitions):
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    names = ("kpis", "customer_table_50", "quality_report")
    expected = {name: values(QUERIES[name](spark, small)) for name in names}
    with_conf(spark__sql__shuffle__partitions=partitions)
    for name in names:
        assert values(QUERIES[name](spark, small)) == expected[name]


def test_results_do_not_depend_on_row_order(spark, small):
    raw = raw_feeds(spark, small)
    mixed = [feed.repartition(7).orderBy(F.hash(*feed.columns)) for feed in raw]
    plain = build_sales_summary(*raw, order_by="seq")
    other = build_sales_summary(*mixed, order_by="seq")
    assert plain.exceptAll(other).isEmpty() and other.exceptAll(plain).isEmpty()


def test_hash_joins_and_sort_joins_agree(spark, small, with_conf):
    plain = sorted(values(sales(spark, small, valid_only=False)), key=str)
    shuffle_everything(with_conf)
    assert sorted(values(sales(spark, small, valid_only=False)), key=str) == plain
