"""First rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``count`` rows of each key in ``order``, with their rank if named.

    The rank filter lets Spark cut every key to ``count`` rows within each input task, so
    a hot key reaches the shuffle with a few rows per task only.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    top = rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= count)
    return top if rank else top.drop(name)


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
