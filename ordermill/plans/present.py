"""Display forms of reports: labels and number texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import currency, thousands

# The headings reports are shown under.
TOP_CUSTOMER_LABELS = {
    "customer_id": "ID",
    "customer_name": "Name",
    "city": "City",
    "total_amount": "Total Spent",
}
BEST_PRODUCT_LABELS = {
    "product_id": "ID",
    "product_name": "Product",
    "category": "Category",
    "units_sold": "Units",
    "revenue": "Revenue",
}
CATEGORY_SHARE_LABELS = {
    "category": "Category",
    "revenue": "Revenue",
    "share_pct": "% Share",
}
CUSTOMER_TABLE_LABELS = {
    "customer_id": "ID",
    "customer_name": "Name",
    "city": "City",
    "orders": "Orders",
    "total_spent": "Total Spent",
    "avg_order": "Avg Order",
}


def present(
    report: DataFrame,
    labels: Mapping[str, str] | None = None,
    money: Sequence[str] = (),
    whole_money: Sequence[str] = (),
    counts: Sequence[str] = (),
) -> DataFrame:
    """A report with number columns as text and its columns relabelled.

    ``money`` gets two decimals, ``whole_money`` none, ``counts`` only commas.
    """
    labels = labels or {}

    def cell(name: str):
        if name in money:
            shown = currency(F.col(name), 2)
        elif name in whole_money:
            shown = currency(F.col(name), 0)
        elif name in counts:
            shown = thousands(F.col(name))
        else:
            shown = F.col(name)
        return shown.alias(labels.get(name, name))

    return report.select(*(cell(name) for name in report.columns))
