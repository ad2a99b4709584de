"""Shape, schema and first rows of a frame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.schema import SOURCE_ORDINAL


def feed_profile(feeds: Mapping[str, DataFrame], order_by: str = SOURCE_ORDINAL) -> DataFrame:
    """Rows and columns of each feed; the row-order column is not counted."""

    def shape(name: str, feed: DataFrame) -> DataFrame:
        columns = sum(column != order_by for column in feed.columns)
        return feed.agg(
            F.lit(name).alias("feed"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(columns).alias("column_count"),
        )

    return reduce(DataFrame.unionByName, (shape(*item) for item in feeds.items()))


def counted_profile(
    counts: DataFrame, feeds: Mapping[str, DataFrame], order_by: str = SOURCE_ORDINAL
) -> DataFrame:
    """As :func:`feed_profile`, from cleaning counts that are there already."""
    widths = {name: sum(c != order_by for c in feed.columns) for name, feed in feeds.items()}
    width = F.coalesce(*(F.when(F.col("feed") == name, F.lit(n)) for name, n in widths.items()))
    return counts.select("feed", F.col("raw_rows").alias("row_count"), width.alias("column_count"))


def preview(frame: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return frame.orderBy(*order_by).limit(n)


def preview_feed(raw: DataFrame, n: int = 3, order_by: str = SOURCE_ORDINAL) -> DataFrame:
    """The first ``n`` rows of a raw feed in file order."""
    return preview(raw, n, order_by).drop(order_by)


def preview_sales(sales: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` sales by date, then order id."""
    return preview(sales, n, "order_date", "order_id")


def schema_report(frame: DataFrame) -> DataFrame:
    """One (position, column_name, data_type) row per column."""
    rows = [
        (position, field.name, field.dataType.simpleString())
        for position, field in enumerate(frame.schema.fields, start=1)
    ]
    return frame.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string"
    )
