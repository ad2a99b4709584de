"""Keep-first deduplication under an explicit row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.schema import SOURCE_ORDINAL

_PLACE = "_place"


def keep_first(frame: DataFrame, key: str, order_by: str = SOURCE_ORDINAL) -> DataFrame:
    """The first row of each key in ``order_by`` order; NULL keys are one group.

    Spark puts a group limit before the shuffle as well as after it, so a key
    held by a third of all rows sends one row per task over the network.
    ``order_by`` must differ between rows of one key.
    """
    rows_of_key = Window.partitionBy(key).orderBy(order_by)
    return (
        frame.withColumn(_PLACE, F.row_number().over(rows_of_key))
        .filter(F.col(_PLACE) == 1)
        .drop(_PLACE, order_by)
    )


def keep_first_counting(
    frame: DataFrame, key: str, order_by: str = SOURCE_ORDINAL, copies: str = "copies"
) -> DataFrame:
    """As :func:`keep_first`, with the number of rows each kept row stands for.

    The sum of ``copies`` is the size of the raw feed, so an audit needs one
    pass over it. Both halves of the aggregate run before and after the shuffle.
    """
    payload = [name for name in frame.columns if name not in (key, order_by)]
    return (
        frame.groupBy(key)
        .agg(
            F.min_by(F.struct(*payload), order_by).alias("_first"),
            F.count(F.lit(1)).alias(copies),
        )
        .select(key, "_first.*", copies)
    )
