"""Lasting counts of rule violations on streams."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from innmetrics.operators.quality import Constraint
from innmetrics.session import folder_exists

_COUNTS = "query STRING, batch BIGINT, dataset STRING, constraint STRING, failed BIGINT, row_count BIGINT"


class RuleCounts(StreamingQueryListener):
    """Writes what every batch observed of the given datasets' rules to a folder.

    The counts come from the batch's own pass, see ``observe``. A batch has one place in
    the folder, by its query's lasting id and its number, so one that is run again after a
    failure counts once. Batches without rows leave nothing.
    """

    def __init__(self, spark: SparkSession, log: str, rules: Mapping[str, Sequence[Constraint]]):
        self.spark, self.log, self.rules = spark, log, rules
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query, batch = str(progress.id), int(progress.batchId)
        lines = []
        for dataset, rules in self.rules.items():
            seen = progress.observedMetrics.get(dataset)
            if seen is not None and seen["row_count"]:
                lines += [(query, batch, dataset, rule.name, seen[rule.name], seen["row_count"]) for rule in rules]
        if lines:
            made = self.spark.createDataFrame(lines, _COUNTS).coalesce(1)
            made.write.mode("overwrite").parquet(f"{self.log}/{query}-{batch}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended(str(event.id)).set()

    def _ended(self, query: str) -> threading.Event:
        return self.ended.setdefault(query, threading.Event())

    def wait(self, query: str, seconds: float = 120) -> None:
        """Until all counts of a query that has ended are written."""
        if not self._ended(query).wait(seconds):
            raise TimeoutError(f"rule counts of query {query} were not written within {seconds} s")


def logged_violations(spark: SparkSession, log: str) -> dict[str, dict[str, int]]:
    """dataset -> constraint -> rows that violated it, with ``row_count``, over all batches;
    the form that ``quality_report`` takes."""
    if not folder_exists(spark, log):
        return {}
    counts: DataFrame = spark.read.schema(_COUNTS).parquet(f"{log}/*")
    summed = counts.groupBy("dataset", "constraint").agg(F.sum("failed").alias("failed"), F.sum("row_count").alias("seen"))
    found: dict[str, dict[str, int]] = {}
    for r in summed.collect():  # a row per rule
        found.setdefault(r.dataset, {"row_count": r.seen})[r.constraint] = r.failed
    return found
