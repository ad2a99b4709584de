"""Column names, fixed texts and the column-presence check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and texts that results depend on.
# ---------------------------------------------------------------------------
CUSTOMER_COLUMNS = ("customer_id", "customer_name", "city", "signup_date")
PRODUCT_COLUMNS = ("product_id", "product_name", "category", "price")
ORDER_COLUMNS = ("order_id", "customer_id", "product_id", "quantity", "order_date")

SALES_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)
SALES_COLUMNS = tuple(SALES_SCHEMA.names)
SALES_TABLE = "sales_summary"

# Texts that count as a missing cell in a CSV feed.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts that count as a number. "nan" is left out: it is a missing number.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Shapes a date text may have, tried in this order.
DATE_FORMATS = ("yyyy-M-d",)

# Dates outside these bounds do not fit 64-bit nanoseconds and count as missing.
EARLIEST_DATE = "1677-09-21 00:12:43.145225"
LATEST_DATE = "2262-04-11 23:47:16.854775"

MONTH_FORMAT = "yyyy-MM"
CURRENCY_SIGN = "₦"
BAR_CHARACTER = "█"
BAR_WIDTH = 30
ANY_VALUE = "All"

# Name of the column that carries a row's place in its source file.
SOURCE_ORDINAL = "source_ordinal"


def require_columns(frame: DataFrame, columns: Iterable[str], feed: str) -> None:
    """Raise if ``frame`` lacks one of ``columns``; extra columns are allowed."""
    missing = [name for name in columns if name not in frame.columns]
    if missing:
        raise ValueError(f"{feed} feed lacks column(s): {', '.join(missing)}")
