import warnings
from datetime import datetime

import pandas as pd
import pytest
from helpers import customers, orders, values
from pandas.tseries.api import guess_datetime_format

from ordermill.functions.dates import format_of
from ordermill.operators import clean
from ordermill.operators.clean import CUSTOMERS, ORDERS, clean_customers, clean_orders, infer_date_formats

# A feed's dates as written, the first of which tells the format.
FEEDS = {
    "slashes, year first": ["2022/01/05", "2022/1/6", "2022-01-07", "x", "2022/13/01"],
    "slashes, month first": ["01/02/2023", "12/31/2023", "13/02/2023", "2023-01-01"],
    "slashes, day first": ["13/02/2023", "01/02/2023", "02/13/2023"],
    "dots": ["13.02.2023", "1.2.2023", "2023.02.01"],
    "dots, year first": ["2023.02.01", "2023.12.31", "01.02.2023"],
    "dashes, day first": ["25-12-2022", "1-2-2023", "2023-02-01"],
    "month names": ["January 5, 2023", "February 16, 2023", "Feb 16, 2023", "March 40, 2023"],
    "short month names": ["05-Jan-2023", "6-Feb-2023", "7 Feb 2023"],
    "short names, day first": ["5 Jan 2023", "16 Dec 2022", "5 January 2023"],
    "short names, month first": ["Jan 5, 2023", "Dec 16, 2022", "Jan 5 2023"],
    "minutes": ["2023-01-05 10:11", "2023-01-06 1:02", "2023-01-06", "2023-01-06 10:11:12"],
    "seconds": ["2023-01-05T10:11:12", "2023-01-06T23:59:59", "2023-01-06 10:11:12"],
    "parts of seconds": ["2023-01-05 10:11:12.5", "2023-01-05 10:11:12.123456", "2023-01-05 10:11:12"],
    "slashes and times": ["01/02/2023 15:04", "12/31/2023 3:04", "01/02/2023"],
    "missing first": [None, None, "2022/01/05", "2022-01-05"],
    "iso": ["2023-01-05", "2023-1-7", "2023-02-30", "2023-01-05 10:11:12", "2023"],
}


def parsed(spark, cells):
    feed = orders(spark, *((f"O{n}", "c", "p", "1", cell) for n, cell in enumerate(cells)))
    found = dict(values(clean_orders(feed, "seq", None), "order_id", "order_date"))
    return [found.get(f"O{n}") for n in range(len(cells))]


@pytest.mark.parametrize("name", FEEDS)
def test_the_first_date_tells_the_format(spark, name):
    cells = FEEDS[name]
    expected = pd.to_datetime(pd.Series(cells), errors="coerce")
    assert parsed(spark, cells) == [None if pd.isna(x) else x.to_pydatetime() for x in expected]
    assert any(parsed(spark, cells))


def test_shapes_are_the_ones_pandas_tells():
    letters = {"%Y": "yyyy", "%m": "M", "%d": "d", "%B": "MMMM", "%b": "MMM", "%H": "H", "%M": "m", "%S": "s", "%f": "S" * 9}
    for cells in FEEDS.values():
        for cell in filter(None, cells):
            guess, own = guess_datetime_format(cell), format_of(cell)
            if guess and own:
                for theirs, ours in letters.items():
                    guess = guess.replace(theirs, ours)
                assert own.replace("'", "") == guess, cell
    assert format_of("01/02/2023 3:04 PM") == "M/d/yyyy h:m a"
    assert [format_of(x) for x in ("", "20230105", "2023-13-01", "1/2/23", "x", "14/14/2023", " 2023-01-05")] == [None] * 7


def test_rows_that_go_first_do_not_tell(spark):
    # The second copy of a key and a customer without a name go before dates are read.
    feed = customers(
        spark, ("a", "A", "X", None, 1), ("a", "A", "X", "2022-01-01", 2), ("b", None, "X", "05.01.2022", 3),
        ("c", "C", "X", "2022/01/05", 4), ("d", "D", "X", "2022-01-06", 5),
    )
    assert infer_date_formats(feed, CUSTOMERS, "seq") == ("yyyy/M/d",)
    assert values(clean_customers(feed.repartition(4), "seq", None), "customer_id") == [("c",)]


def test_stated_formats_win(spark):
    feed = orders(spark, ("1", "c", "p", "1", "01/02/2023"), ("2", "c", "p", "1", "2023-03-04"))
    first = datetime(2023, 2, 1), datetime(2023, 3, 4)
    assert values(clean_orders(feed, "seq", ["d/M/yyyy"]), "order_date") == [(first[0],)]
    assert sorted(values(clean_orders(feed, "seq", {"orders": ["d/M/yyyy", "yyyy-M-d"]}), "order_date")) == [(d,) for d in first]
    assert values(clean_orders(feed, "seq", {"customers": ["yyyy"]}), "order_date") == [(datetime(2023, 1, 2),)]


@pytest.mark.parametrize("cell", [None, "soon", "20230105"])
def test_feeds_without_a_known_date_say_so(spark, cell):
    feed = orders(spark, ("1", "c", "p", "1", cell), ("2", "c", "p", "1", cell))
    with pytest.warns(UserWarning, match="no known date format in orders.order_date"):
        assert infer_date_formats(feed, ORDERS, "seq") == ("yyyy-M-d",)
    with pytest.raises(ValueError, match="state date_formats"):
        infer_date_formats(feed, ORDERS, "seq", strict=True)


def test_empty_and_typed_feeds_need_no_format(spark):
    feed = orders(spark, ("1", "c", "p", "1", "2023/01/05"))
    typed = feed.withColumn("order_date", feed.seq.cast("timestamp"))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        for frame in (feed.limit(0), typed):
            assert infer_date_formats(frame, ORDERS, "seq", strict=True) == ("yyyy-M-d",)


def test_more_rows_are_fetched_while_none_tells(spark, monkeypatch):
    monkeypatch.setattr(clean, "FIRST_ROWS", 2)
    feed = orders(spark, *((f"O{n}", "c", "p", "1", None if n < 60 else "2023/01/05") for n in range(70)))
    assert infer_date_formats(feed, ORDERS, "seq") == ("yyyy/M/d",)
