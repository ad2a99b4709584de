"""Report filters and the values they offer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.schema import ANY_VALUE


def apply_filters(
    sales: DataFrame,
    category: str | None = None,
    city: str | None = None,
    months: tuple[str | None, str | None] = (None, None),
) -> DataFrame:
    """Sales of one category, one city and a range of months, both ends included.

    ``None`` or ``"All"`` leaves a category or city open; a ``None`` month
    leaves that end open. All tests reach the scan of a stored fact, and on a
    fact laid out by month the range prunes folders.
    """
    kept = sales
    if category not in (None, ANY_VALUE):
        kept = kept.filter(F.col("category") == category)
    if city not in (None, ANY_VALUE):
        kept = kept.filter(F.col("city") == city)
    first, last = months
    kept = kept.filter(F.col("year_month").isNotNull())
    if first is not None:
        kept = kept.filter(F.col("year_month") >= first)
    if last is not None:
        kept = kept.filter(F.col("year_month") <= last)
    return kept


def filter_values(sales: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of one column."""
    return sales.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def filter_domains(sales: DataFrame) -> DataFrame:
    """All choices of the three filters as (domain, position, value) rows.

    Category and city start with the open choice at position 0. The three
    lists come out of one pass.
    """
    pair = "struct('{0}' AS domain, {0} AS value)"
    columns = ("category", "city", "year_month")
    listed = (
        sales.selectExpr(f"inline(array({', '.join(pair.format(c) for c in columns)}))")
        .filter(F.col("value").isNotNull())
        .distinct()
        .select(
            "domain",
            F.row_number()
            .over(Window.partitionBy("domain").orderBy("value"))
            .alias("position"),
            "value",
        )
    )
    open_choices = sales.sparkSession.sql(
        f"SELECT * FROM VALUES ('category', 0, '{ANY_VALUE}'), ('city', 0, '{ANY_VALUE}') "
        "AS choices(domain, position, value)"
    )
    return open_choices.unionByName(listed).orderBy("domain", "position")
