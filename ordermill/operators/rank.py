"""Top-k lists and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(frame: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``, largest first.

    Each task hands on at most ``k`` rows, so there is no full sort. The
    ``ties`` columns make the choice and the order definite.
    """
    return frame.orderBy(F.desc(by), *(F.asc(name) for name in ties)).limit(k)


def top_k_ascending(frame: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The same ``k`` rows, largest last."""
    best = top_k(frame, k, by, ties)
    return best.orderBy(F.asc(by), *(F.desc(name) for name in ties))


def ranked(limited: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """Add a 1-based ``rank`` in front. Only for an already limited frame."""
    order = Window.orderBy(F.desc(by), *(F.asc(name) for name in ties))
    return limited.select(F.row_number().over(order).alias("rank"), "*")
