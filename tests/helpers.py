"""Hand-written feeds and facts."""

from datetime import datetime

from ordermill.schema import SALES_SCHEMA

CUSTOMER_FEED = "customer_id string, customer_name string, city string, signup_date string, seq int"
PRODUCT_FEED = "product_id string, product_name string, category string, price string, seq int"
ORDER_FEED = (
    "order_id string, customer_id string, product_id string, "
    "quantity string, order_date string, seq int"
)


def customers(spark, *rows):
    """(id, name, city) rows with a good signup date, or whole rows."""
    full = [row if len(row) == 5 else (*row, "2022-01-01", n) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, CUSTOMER_FEED)


def products(spark, *rows):
    """(id, name, category, price) rows, or whole rows."""
    full = [row if len(row) == 5 else (*row, n) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, PRODUCT_FEED)


def orders(spark, *rows):
    """(id, customer, product, quantity, date) rows, or whole rows."""
    full = [row if len(row) == 6 else (*row, n) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, ORDER_FEED)


def fact(spark, *rows):
    """Fact rows from keyword dicts; what is left out is NULL or follows from the rest."""
    full = []
    for number, row in enumerate(rows):
        row = {"order_id": f"O{number}", "order_date": datetime(2023, 1, 5), **row}
        if row["order_date"] is not None:
            row.setdefault("year_month", row["order_date"].strftime("%Y-%m"))
        full.append(tuple(row.get(name) for name in SALES_SCHEMA.names))
    return spark.createDataFrame(full, SALES_SCHEMA)


def values(frame, *columns):
    """Rows as plain tuples, in the frame's own order."""
    rows = frame.select(*columns) if columns else frame
    return [tuple(row) for row in rows.collect()]
