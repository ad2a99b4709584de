import csv
from datetime import datetime
from pathlib import Path

import pytest
from helpers import fact, values
from pyspark.sql import functions as F

from checks import registry
from ordermill.operators.filters import apply_filters
from ordermill.plans.profile import feed_profile, preview_feed, preview_sales, schema_report
from ordermill.plans.sales import valid_sales
from ordermill.schema import SALES_COLUMNS, SALES_SCHEMA
from ordermill.sources import store


@pytest.fixture
def sales(spark):
    return fact(
        spark,
        *(
            {
                "order_date": datetime(2023, 1 + n % 3, 1 + n % 28),
                "customer_name": 'quote " and, comma',
                "product_name": None if n % 7 == 0 else "p",
                "category": None if n % 5 == 0 else "k",
                "quantity": float(n),
                "total_amount": n / 4,
            }
            for n in range(60)
        ),
    )


def same(left, right):
    return sorted(values(left, *SALES_COLUMNS), key=str) == sorted(
        values(right, *SALES_COLUMNS), key=str
    )


@pytest.mark.parametrize("by_month", [True, False])
def test_store_and_open(spark, sales, tmp_path, by_month):
    path = str(tmp_path / "sales")
    store.save_sales(sales.limit(3), path, by_month)
    store.save_sales(sales, path, by_month)
    stored = store.open_sales(spark, path)
    assert same(stored, sales)
    assert stored.columns == list(SALES_COLUMNS)
    meant = spark.createDataFrame([(60,)], "n bigint")
    assert values(store.verify_load(stored, meant)) == [(60, 60, True)]
    assert values(store.verify_load(stored, meant.selectExpr("n - 1"))) == [(60, 59, False)]
    assert same(store.open_sales(spark, path, valid_only=True), valid_sales(sales))
    months = {p.name for p in (tmp_path / "sales").glob("fact-*/is_valid=true/year_month=*")}
    expected = {f"year_month=2023-0{m}" for m in (1, 2, 3)} if by_month else set()
    assert months == expected


def test_months_that_are_gone_do_not_stay(spark, sales, tmp_path, with_conf):
    with_conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    path = str(tmp_path / "sales")
    store.save_sales(sales, path)
    january = sales.filter("year_month = '2023-01'")
    store.save_sales(january, path)
    assert same(store.open_sales(spark, path), january)


def test_rows_without_a_month_are_stored_too(spark, sales, tmp_path):
    undated = fact(spark, {"order_id": "u", "order_date": None})
    path = str(tmp_path / "sales")
    store.save_sales(sales.unionByName(undated), path)
    assert same(store.open_sales(spark, path), sales.unionByName(undated))


def test_catalog_table_is_replaced(spark, sales):
    store.save_sales_table(sales.limit(3), "sales_summary_test")
    store.save_sales_table(sales, "sales_summary_test")
    table = spark.table("sales_summary_test")
    assert table.columns == list(SALES_COLUMNS)
    assert same(table, sales)
    assert values(schema_report(table), "column_name") == [(c,) for c in SALES_COLUMNS]
    spark.sql("DROP TABLE sales_summary_test")


def test_month_filter_prunes_folders(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    store.save_sales(sales, path)
    valid = store.open_sales(spark, path, valid_only=True)
    picked = apply_filters(valid, "k", None, ("2023-02", "2023-02"))
    plan = picked.select("total_amount")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partition_filters = scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "year_month" in partition_filters and "is_valid" in partition_filters
    assert "EqualTo(category,k)" in scan
    assert scan.split("ReadSchema: ")[1].startswith("struct<category:string,total_amount:double>")
    assert picked.count() == sum(n % 3 == 1 and n % 5 != 0 and n % 7 != 0 for n in range(60))


def test_export_in_date_order(spark, sales, tmp_path):
    path = str(tmp_path / "export")
    store.export_csv(sales, path)
    assert same(store.read_csv_export(spark, path), sales)
    lines = []
    for part in sorted((tmp_path / "export").glob("part-*.csv")):
        text = part.read_text(encoding="utf-8").splitlines()
        assert text[0] == ",".join(SALES_COLUMNS)
        lines += text[1:]
    dates = [line.split(",")[1] for line in lines]
    assert len(dates) == 60 and dates == sorted(dates)
    assert dates[0] == "2023-01-01"


def test_export_of_one_file(spark, sales, tmp_path):
    names = ["  padded  ", "two\nlines", "", None, 'said "so", twice', " ", "a\\b"]
    odd = fact(spark, *({"order_id": f"x{i}", "customer_name": n} for i, n in enumerate(names)))
    rows = sales.unionByName(odd).repartition(6)
    path = tmp_path / "sales.csv"
    path.write_text("an old file")
    store.export_csv(rows, str(path), single_file=True)
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["sales.csv"]
    with path.open(encoding="utf-8", newline="") as file:
        lines = list(csv.reader(file))
    assert lines[0] == list(SALES_COLUMNS) and len(lines) == 68 and lines.count(lines[0]) == 1
    dates = [line[1] for line in lines[1:]]
    assert dates == sorted(dates)
    assert same(store.read_csv_export(spark, str(path)), rows)
    folder = str(tmp_path / "folder")
    store.export_csv(rows, folder)
    assert same(store.read_csv_export(spark, folder), store.read_csv_export(spark, str(path)))
    store.export_csv(sales.limit(0), str(path), single_file=True)
    assert path.read_text(encoding="utf-8") == ",".join(SALES_COLUMNS) + "\n"


@pytest.mark.parametrize("single_file", [False, True])
def test_an_export_builds_its_rows_once(spark, sales, tmp_path, single_file):
    built = spark.sparkContext.accumulator(0)

    def same_name(name):
        built.add(1)
        return name

    noted = F.udf(same_name, "string").asNondeterministic()
    rows = sales.withColumn("customer_name", noted("customer_name"))
    path = str(tmp_path / "sales.csv")
    store.export_csv(rows, path, single_file=single_file)
    assert built.value == 60
    assert same(store.read_csv_export(spark, path), sales)
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["sales.csv"]


def test_a_refused_load_of_valid_rows_reads_what_is_stored(spark, small, monkeypatch):
    built = []
    real = registry.sales

    def noted(spark, folder, valid_only):
        built.append(valid_only)
        return real(spark, folder, valid_only)

    monkeypatch.setattr(registry, "sales", noted)
    kept = registry.QUERIES["load_kept_after_failure"](spark, small)
    assert built == [False]
    assert same(kept, real(spark, small, False))


def test_no_task_of_a_single_export_gets_all_rows(spark, sales, tmp_path, with_conf, monkeypatch):
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    parts = []
    real = store.join_files

    def seen(spark, folder, path, header):
        parts.extend(p.read_text(encoding="utf-8").count("\n") for p in Path(folder).glob("part-*"))
        real(spark, folder, path, header)

    monkeypatch.setattr(store, "join_files", seen)
    store.export_csv(sales.repartition(4), str(tmp_path / "one.csv"), single_file=True)
    assert sum(parts) == 60 and max(parts) < 30


def test_parts_are_joined_by_number(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for number in (99_999, 100_000, 7):
        (folder / f"part-{number:05d}-x.csv").write_text(f"{number}\n")
    store.join_files(spark, str(folder), str(tmp_path / "one.csv"), "n\n")
    assert (tmp_path / "one.csv").read_text() == "n\n7\n99999\n100000\n"


def test_export_keeps_times(spark, tmp_path):
    path = str(tmp_path / "export")
    moments = [datetime(2023, 1, 5), datetime(2023, 1, 5, 7, 8, 9), datetime(2023, 1, 5, 7, 8, 9, 120)]
    sales = fact(spark, *({"order_date": m} for m in moments))
    store.export_csv(sales, path)
    assert same(store.read_csv_export(spark, path), sales)


def test_export_keeps_cells(spark, tmp_path):
    names = ["  padded  ", "two\nlines", "", None, 'said "so", twice', " ", "a\\b"]
    sales = fact(spark, *({"customer_name": n, "product_name": n} for n in names))
    path = str(tmp_path / "export")
    store.export_csv(sales, path)
    assert same(store.read_csv_export(spark, path), sales)
    texts = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "export").glob("part-*.csv"))
    assert " 00:00" not in texts


def test_a_wrong_store_shows(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    wrong = sales.withColumn("quantity", sales.quantity.cast("string")).withColumn("extra", sales.price)
    store.save_sales(wrong, path)
    report = {row[1]: row[2] for row in values(schema_report(store.stored_columns(spark, path)))}
    assert report["quantity"] == "string" and "extra" in report and len(report) == 13
    store.save_sales(sales, path)
    right = values(schema_report(store.stored_columns(spark, path)), "column_name", "data_type")
    assert right == [(f.name, f.dataType.simpleString()) for f in SALES_SCHEMA]


def failing(sales):
    """The rows, but one of them cannot be computed."""
    bad = F.when(F.col("order_id") == "O41", F.raise_error("broken cell").cast("double"))
    return sales.withColumn("total_amount", F.coalesce(bad, F.col("total_amount")))


@pytest.mark.parametrize("by_month", [True, False])
def test_a_load_that_fails_leaves_the_old_fact(spark, sales, tmp_path, by_month):
    path = str(tmp_path / "sales")
    store.save_sales(sales, path, by_month)
    with pytest.raises(Exception, match="broken cell"):
        store.save_sales(failing(sales), path, by_month)
    assert same(store.open_sales(spark, path), sales)

    def refuse(loaded):
        assert loaded.count() == 3
        raise RuntimeError("not what was meant")

    with pytest.raises(RuntimeError, match="not what was meant"):
        store.save_sales(sales.limit(3), path, by_month, check=refuse)
    assert same(store.open_sales(spark, path), sales)
    assert len(list((tmp_path / "sales").glob("fact-*"))) == 1


def test_a_killed_load_leaves_the_old_fact(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    store.save_sales(sales, path)
    # What a driver that is gone leaves: a folder that nobody verified, with half of the rows.
    sales.limit(30).write.parquet(f"{path}/fact-00000002-dead")
    assert same(store.open_sales(spark, path), sales)
    store.save_sales(sales.limit(7), path)
    assert store.open_sales(spark, path).count() == 7
    assert [p.name.split("-")[1] for p in (tmp_path / "sales").glob("fact-*")] == ["00000003"]


def test_a_path_whose_only_load_was_killed_is_no_empty_fact(spark, sales, tmp_path):
    sales.write.parquet(str(tmp_path / "sales" / "fact-00000001-dead"))
    with pytest.raises(FileNotFoundError, match="verified"):
        store.open_sales(spark, str(tmp_path / "sales"))


def test_a_fact_stored_without_versions_is_read_and_replaced(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    flagged = sales.withColumn("is_valid", F.col("product_name").isNotNull())
    flagged.write.partitionBy("is_valid", "year_month").parquet(path)
    assert same(store.open_sales(spark, path), sales)
    store.save_sales(sales.limit(5), path)
    assert store.open_sales(spark, path).count() == 5
    assert not list((tmp_path / "sales").glob("is_valid=*"))


def test_one_changed_cell_fails_the_load(spark, sales, tmp_path, monkeypatch):
    path = str(tmp_path / "sales")
    store.save_sales(sales, path)
    real = store._read

    def damaged(spark, folder, like):
        found = real(spark, folder, like)
        return found.withColumn("quantity", F.when(F.col("order_id") != "O9", F.col("quantity")))

    monkeypatch.setattr(store, "_read", damaged)
    with pytest.raises(RuntimeError, match="not those written"):
        store.save_sales(sales, path)
    assert same(store.open_sales(spark, path), sales)


def test_the_digest_tells_rows_apart(spark, sales):
    def digest(frame):
        return frame.agg(*store.content_digest(list(SALES_COLUMNS))).first()

    whole = digest(sales)
    assert digest(sales.repartition(7)) == whole
    swapped = sales.withColumn("customer_name", F.col("city")).withColumn("city", F.col("customer_name"))
    assert digest(swapped) != whole
    moved = sales.withColumn("category", F.when(F.col("category").isNull(), "k"))
    assert digest(moved) != whole
    assert digest(sales.union(sales.limit(1))) != whole
    assert digest(sales.limit(0)).n_rows == 0


def test_rows_counted_twice_while_writing_do_not_fail_a_load(spark, sales, tmp_path):
    # A task that ran twice is in the observed sums twice; the plan is then counted again.
    folder = store.save_sales(sales, str(tmp_path / "sales"))
    flagged = sales.withColumn("is_valid", F.expr("customer_name IS NOT NULL AND product_name IS NOT NULL"))
    store._same_content(spark, flagged, {"n_rows": 61, "digest": 1}, folder)


def test_relational_sink_bounds_its_connections(sales, monkeypatch):
    calls = []
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameWriter.jdbc",
        lambda self, url, table, properties: calls.append((url, table, properties)),
    )
    store.save_sales_jdbc(sales, "jdbc:x", properties={"user": "u"})
    assert calls == [("jdbc:x", "sales_summary", {"numPartitions": "16", "user": "u"})]


def test_schema_report(sales):
    report = values(schema_report(sales))
    assert [row[0] for row in report] == list(range(1, 13))
    assert dict(row[1:] for row in report) == {
        f.name: f.dataType.simpleString() for f in SALES_SCHEMA
    }


def test_previews_and_profile(spark, sales):
    feed = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "x string, seq int")
    assert values(preview_feed(feed, 2, "seq")) == [("a",), ("b",)]
    assert values(feed_profile({"one": feed, "two": feed.limit(1)}, "seq")) == [
        ("one", 3, 1), ("two", 1, 1),
    ]
    dates = values(preview_sales(sales, 5), "order_date")
    assert len(dates) == 5 and dates == sorted(dates)
