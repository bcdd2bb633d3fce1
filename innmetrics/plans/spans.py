"""Spans of traces as trees: depth, path and own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.session import work_folder


def span_tree(spans: DataFrame, trace: Sequence[str], span: str, parent: str, duration: str | None = None) -> DataFrame:
    """Adds to each span its ``depth`` (0 for a root), ``path`` (span ids from the root on,
    joined by "/") and, with ``duration``, ``own_time``: what its direct children leave.

    A span without a parent, or whose parent is not in its trace, is a root. Spans in a
    cycle, and those below one, have no root: depth and path are null. Span ids are unique
    within a trace.

    Ways up double in each round: a span that knows the way to some ancestor adds the way
    that this one knows. A trace of depth d takes log2(d) rounds, each an equi-join by span,
    so no trace is gathered in one row or task. A way longer than its trace has spans runs
    in a cycle.
    """
    trace = list(trace)
    key = [*trace, "_span"]
    sizes = spans.groupBy(*trace).agg(F.count("*").alias("_size"))
    there = spans.select(*trace, F.col(span).alias("_up"), F.lit(True).alias("_there"))
    start = spans.select(*trace, F.col(span).alias("_span"), F.col(parent).alias("_up"))
    ways = start.join(there, [*trace, "_up"], "left").join(sizes, trace)
    ways = ways.select(
        *key,
        "_size",
        F.when(F.col("_there"), F.col("_up")).alias("_up"),
        F.lit(1).cast("bigint").alias("_length"),
        F.col("_span").cast("string").alias("path"),
    )
    while True:
        ways = _written(ways)
        climbing = ways.where("_up IS NOT NULL")
        if climbing.isEmpty():
            break
        above = ways.select(
            *trace,
            F.col("_span").alias("_up"),
            F.col("_up").alias("_next"),
            F.col("_length").alias("_more"),
            F.col("path").alias("_before"),
        )
        length = F.col("_length") + F.col("_more")  # null once a cycle is known
        rooted = length <= F.col("_size")
        moved = climbing.join(above, [*trace, "_up"]).select(
            *key,
            "_size",
            F.when(rooted, F.col("_next")).alias("_up"),
            F.when(rooted, length).alias("_length"),
            F.when(rooted, F.concat_ws("/", "_before", "path")).alias("path"),
        )
        ways = ways.where("_up IS NULL").unionByName(moved)
    found = ways.select(*trace, F.col("_span").alias(span), (F.col("_length") - 1).alias("depth"), "path")
    made = spans.join(found, [*trace, span])
    if duration is None:
        return made
    below = spans.groupBy(*trace, F.col(parent).alias(span)).agg(F.sum(duration).alias("_below"))
    own = F.col(duration) - F.coalesce("_below", F.lit(0))
    return made.join(below, [*trace, span], "left").withColumn("own_time", own).drop("_below")


def _written(rows: DataFrame) -> DataFrame:
    path = work_folder(rows.sparkSession, "spans")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
