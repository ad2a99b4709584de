import csv
import io
import random
from pathlib import Path

import pytest
from helpers import values

from checks import registry
from ordermill.operators.clean import clean_customers
from ordermill.schema import CUSTOMER_COLUMNS, SOURCE_ORDINAL
from ordermill.sources import csv_feeds
from ordermill.sources.csv_feeds import (
    has_line_breaks_in_cells,
    head_of_feed,
    read_customers,
    read_feed,
    read_orders,
)

HEADER = "customer_id,customer_name,city,signup_date\n"


@pytest.fixture
def write(tmp_path):
    def write_file(text, name="feed.csv"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text.encode("utf-8"))
        return str(path)

    return write_file


def cells(frame):
    return values(frame.orderBy(SOURCE_ORDINAL).drop(SOURCE_ORDINAL))


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_quotes_names_and_missing_texts(spark, write, multi_line):
    path = write(
        HEADER
        + 'a,"Doe, Jane",Lagos,2022-01-01\n'
        + 'b,"She said ""hi""",NA,2022-01-02\n'
        + "\n"
        + "c,Ọlá ₦,,null\n"
        + 'd,short\n'
        + 'e," padded ",n/a,"2022-01-05"\n'
    )
    assert cells(read_customers(spark, path, multi_line=multi_line)) == [
        ("a", "Doe, Jane", "Lagos", "2022-01-01"),
        ("b", 'She said "hi"', None, "2022-01-02"),
        ("c", "Ọlá ₦", None, None),
        ("d", "short", None, None),
        ("e", " padded ", None, "2022-01-05"),
    ]


def test_line_breaks_inside_cells_are_found(spark, write):
    broken = write(HEADER + 'a,"two\nlines",X,2022-01-01\nb,B,Y,2022-01-02\n', "broken.csv")
    plain = write(HEADER + 'a,"one ""line""",X,2022-01-01\n', "plain.csv")
    assert has_line_breaks_in_cells(spark, broken)
    assert not has_line_breaks_in_cells(spark, plain)
    assert cells(read_customers(spark, broken)) == [
        ("a", "two\nlines", "X", "2022-01-01"),
        ("b", "B", "Y", "2022-01-02"),
    ]


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize(
    "row",
    ["a,A,X,2022-01-01,extra", 'a,"A,A",X,2022-01-01,', "a,A,X,,x", 'a,5" x, 6" y,X,2022-01-01'],
)
def test_surplus_cells_stop_the_read(spark, write, multi_line, row):
    path = write(HEADER + "z,Z,Z,2022-01-01\n" + row + "\n")
    feed = read_customers(spark, path, multi_line=multi_line)
    for action in (feed.collect, feed.count, clean_customers(feed).count):
        with pytest.raises(Exception, match="surplus cells"):
            action()
    kept = read_customers(spark, path, multi_line=multi_line, surplus="drop")
    assert kept.count() == 2
    assert clean_customers(kept).count() >= 1


@pytest.mark.parametrize("row", ['"a,A,X,2022-01-01', 'a,"A,X,2022-01-01', 'a,A,X,"2022-01-01'])
def test_a_quote_never_closed_is_refused(spark, write, row):
    write(HEADER + "z,Z,Z,2022-01-01\n", "many/fine.csv")
    path = write(HEADER + f"z,Z,Z,2022-01-01\n{row}\nb,B,Y,2022-01-02\nc,C,Y,2022-01-03\n", "many/odd one.csv")
    with pytest.raises(ValueError, match="odd one.csv"):
        read_customers(spark, path.rsplit("/", 1)[0])


ROWS = [f"{c},{c.upper()},X,2022-01-0{n}" for n, c in enumerate("abcdefg", start=1)]


@pytest.mark.parametrize(("first", "second"), [(1, 5), (1, 2), (0, 6)])
@pytest.mark.parametrize("cell", ['"{},', '{},"'])
def test_two_quotes_never_closed_are_refused(spark, write, first, second, cell):
    rows = [cell.format(row[0]) + row[2:] if n in (first, second) else row for n, row in enumerate(ROWS)]
    path = write(HEADER + "\n".join(rows) + "\n", "odd.csv")
    with pytest.raises(ValueError, match="quote that is never closed in .*odd.csv"):
        read_customers(spark, path)
    taken = read_customers(spark, path, open_quotes="accept", surplus="drop").count()
    assert taken < len(ROWS)


def test_a_cell_that_holds_a_row_is_named(spark, write):
    # Another file's quotes are in balance here, so only the cells tell.
    path = write(HEADER + ROWS[0] + '\nb,"B,X,2022-01-02\nc,C,X,2022-01-03\nd,"D",X,2022-01-04\n"e",E,X,2022-01-05"\n', "odd.csv")
    for options in ({"multi_line": True}, {}):
        with pytest.raises(Exception, match="(?s)never closed.*odd.csv"):
            read_customers(spark, path, surplus="drop", **options).collect()
    listed = 'g,"G\none, two, three, four\nend",X,2022-01-07\n'
    path = write(HEADER + ROWS[0] + "\n" + listed, "listed.csv")
    with pytest.raises(Exception, match="(?s)holds a whole row.*listed.csv.*one, two, three, four"):
        read_customers(spark, path).count()
    assert cells(read_customers(spark, path, open_quotes="accept"))[1][1] == "G\none, two, three, four\nend"


def test_whole_cells_over_lines_are_not_suspected(spark, write):
    rnd = random.Random(7)
    parts = ["word", '"', "\n", ", ", '""', "5\" x", "é", '",', ',"', " "]
    rows = []
    for n in range(300):
        name = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 8)))
        name = "\n".join(line.replace(",", "", max(0, line.count(",") - 2)) for line in name.split("\n"))
        rows.append((f"c{n:03d}", name.strip() or "x", "two\nlines" if n % 9 == 0 else "X", "2022-01-01"))
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([HEADER.strip().split(","), *rows])
    path = write(text.getvalue(), "fine.csv")
    # The balance of quotes is judged file by file, the cells as they are read.
    assert cells(read_customers(spark, path)) == rows


@pytest.mark.parametrize("encoding", ["UTF-16", "ISO-8859-1"])
def test_other_encodings_keep_cells_that_span_lines(spark, tmp_path, encoding):
    path = tmp_path / "feed.csv"
    path.write_text(HEADER + 'a,"é\nü",X,2022-01-01\nb,ö,Y,2022-01-02\n', encoding=encoding)
    feed = read_customers(spark, str(path), encoding=encoding)
    assert cells(feed) == [("a", "é\nü", "X", "2022-01-01"), ("b", "ö", "Y", "2022-01-02")]


def test_the_row_order_is_three_numbers(spark, write):
    names = ["b c.csv", "a+b.csv", "z é.csv", "a.csv"]
    for name in names:
        path = write(HEADER + "".join(f"{name}{n},N,X,2022-01-01\n" for n in range(3)), f"many/{name}")
    folder = path.rsplit("/", 1)[0]
    for multi_line in (False, True, None):
        feed = read_customers(spark, folder, multi_line=multi_line)
        assert feed.schema[SOURCE_ORDINAL].dataType.simpleString() == "struct<file:int,block:bigint,row:bigint>"
        found = [r[0] for r in values(feed.repartition(4).orderBy(SOURCE_ORDINAL), "customer_id")]
        assert found == [f"{name}{n}" for name in sorted(names) for n in range(3)]
    plan = clean_customers(feed)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert exchanges and not any("file_path" in line or "_file" in line for line in exchanges)
    single = read_customers(spark, f"{folder}/a.csv")
    assert "Join" not in single._jdf.queryExecution().executedPlan().toString()


def test_paths_too_many_to_hand_out_are_the_order_themselves(spark, write, monkeypatch):
    monkeypatch.setattr(csv_feeds, "MOST_PATH_CHARACTERS", 10)
    for number in range(3):
        path = write(HEADER + f"c{number},N,X,2022-01-01\n", f"many/part-{number}.csv")
    feed = read_customers(spark, path.rsplit("/", 1)[0])
    assert [r[0] for r in values(feed.orderBy(SOURCE_ORDINAL), "customer_id")] == ["c0", "c1", "c2"]


def test_a_stray_quote_in_a_cell_is_a_character(spark, write):
    path = write(HEADER + 'a,5" pipe,X,2022-01-01\nb,B,Y,2022-01-02\n')
    assert not has_line_breaks_in_cells(spark, path)
    assert cells(read_customers(spark, path))[0] == ("a", '5" pipe', "X", "2022-01-01")


def test_only_files_with_line_breaks_stay_whole(spark, write, with_conf):
    with_conf(spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="0")
    body = "".join(f"c{n:05d},N,X,2022-01-01\n" for n in range(2000))
    write(HEADER + body, "mixed ü/part-1.csv")
    path = write(HEADER + 'a,"two\nlines",X,2022-01-01\n' + body, "mixed ü/part-0.csv")
    feed = read_customers(spark, path.rsplit("/", 1)[0])
    assert feed.rdd.getNumPartitions() > 10
    found = cells(feed)
    assert len(found) == 4001 and found[0] == ("a", "two\nlines", "X", "2022-01-01")
    assert found[1:] == found[1:2001] * 2


def test_header_only_and_byte_order_mark(spark, write):
    assert read_customers(spark, write(HEADER)).count() == 0
    marked = write("﻿" + HEADER + "a,A,X,2022-01-01\n", "bom.csv")
    for multi_line in (True, False):
        frame = read_customers(spark, marked, multi_line=multi_line)
        assert cells(frame) == [("a", "A", "X", "2022-01-01")]


def test_columns_go_by_name_and_extra_ones_stay(spark, write):
    path = write("note,city,customer_name,signup_date,customer_id\nn,X,A,2022-01-01,a\n")
    frame = read_customers(spark, path)
    assert values(frame, "customer_id", "customer_name", "note") == [("a", "A", "n")]
    assert values(clean_customers(frame), "customer_id", "city") == [("a", "X")]


def test_a_missing_column_is_named(spark, write):
    with pytest.raises(ValueError, match="signup_date"):
        read_customers(spark, write("customer_id,customer_name,city\na,A,X\n"))


def test_files_with_other_headers_are_refused(spark, write):
    write("a,b\n1,2\n", "many/part1.csv")
    path = write("b,a\n3,4\n", "many/part2.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, path.rsplit("/", 1)[0], ["a", "b"]).collect()


def test_order_over_many_splits_and_files(spark, write, with_conf):
    with_conf(spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="0")
    lines = ["order_id,customer_id,product_id,quantity,order_date"]
    for number in range(3):
        body = [f"o{n},c,p{number}-{n:05d},1,2023-01-05" for n in range(2000)]
        path = write("\n".join(lines + body) + "\n", f"split/part-{number}.csv")
    feed = read_orders(spark, path.rsplit("/", 1)[0], multi_line=False)
    assert feed.rdd.getNumPartitions() > 20
    found = [r[0] for r in values(feed.repartition(5).orderBy(SOURCE_ORDINAL), "product_id")]
    assert found == sorted(found) and len(found) == 6000


def test_head_reads_on_past_files_without_rows(spark, write):
    names = [f"odd name é/part-{n:02d}.csv" for n in range(8)]
    for number, name in enumerate(names):
        body = f"c{number},N,X,2022-01-01\n" * 2 if number in (1, 4, 5) else ""
        path = write(HEADER + body, name)
    folder = path.rsplit("/", 1)[0]
    head = head_of_feed(spark, folder, CUSTOMER_COLUMNS, 3)
    assert values(head, "customer_id") == [("c1",), ("c1",), ("c4",)]
    assert len(values(head_of_feed(spark, folder, CUSTOMER_COLUMNS, 50))) == 6
    assert SOURCE_ORDINAL not in head.columns


def test_bad_option(spark, write):
    with pytest.raises(ValueError):
        read_customers(spark, write(HEADER), surplus="ignore")


def test_only_lines_with_a_quote_are_looked_at_by_patterns(spark, tmp_path, monkeypatch):
    # A pattern that fits the plain line too: were it asked, that line could close what the other opens.
    monkeypatch.setattr(csv_feeds, "_CLOSES", "^plain")
    path = tmp_path / "feed.csv"
    path.write_text('a,b\nx"y,"z\nplain,1\n')
    with pytest.raises(ValueError, match="never closed"):
        csv_feeds.files_with_line_breaks(spark, str(path))
    assert len(csv_feeds.files_with_line_breaks(spark, str(path), open_quotes="accept")) == 1
    path.write_text("a,b\nplain,1\n")
    assert csv_feeds.files_with_line_breaks(spark, str(path)) == []


def test_a_written_feed_is_sorted_by_the_fields_of_its_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_path", lambda spark, purpose: str(tmp_path / purpose))
    rows = [(f"r{n}", n % 3 or None, -n) for n in range(40)]
    feed = spark.createDataFrame(rows, "name string, a int, b int").selectExpr("name", "struct(a, b) AS seq").repartition(5)
    orders, kind = [], type(feed)
    real = kind.orderBy
    monkeypatch.setattr(kind, "orderBy", lambda rows, *by: orders.append(by) or real(rows, *by))
    path = registry._as_csv(spark, feed, "rows")
    assert orders == [("seq.a", "seq.b")]
    lines = [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines() if line != "name"]
    assert lines == [name for name, *_ in sorted(rows, key=lambda r: (r[1] or 0, r[2]))]
