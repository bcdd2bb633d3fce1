"""Dense row numbers without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1009


def dense_index(ids: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Numbers distinct integer ids 0, 1, 2, ... in the order (id mod BUCKETS, id).

    Each bucket is numbered on its own and shifted by the size of the buckets before it;
    only the bucket sizes, at most BUCKETS rows, meet in one task.
    """
    keyed = ids.select(column).distinct().withColumn(
        "_bucket", F.pmod(F.col(column), F.lit(BUCKETS)).cast("int")
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return (
        keyed.withColumn("_place", within)
        .join(F.broadcast(shifts), "_bucket")  # at most BUCKETS rows
        .select(column, (F.col("_shift") + F.col("_place") - 1).cast("bigint").alias(name))
    )
