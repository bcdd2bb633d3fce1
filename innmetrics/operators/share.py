"""Shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.functions.measures import percent_share


def count_shares(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Row count per group and its share of all rows in percent.

    The total is a scalar subquery over the same grouped counts, whose shuffle is reused;
    a window over everything would pull all groups into one task.
    """
    counts = rows.groupBy(*group).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("percentage", percent_share(F.col("count"), total))
