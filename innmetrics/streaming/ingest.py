"""Incremental ingest of clickstream files into the cleaned event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from innmetrics.operators.quality import enforce
from innmetrics.plans.silver import CLICKSTREAM_RULES, flat_clickstream
from innmetrics.streaming.rules import RuleCounts

#: Name of the cleaned events, in reports and in the query's progress.
DATASET = "silver_clickstream"


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New files below ``path`` (a folder or a glob). The source must only ever gain files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def ingest_clickstream(
    clickstream: DataFrame, sink: str, checkpoint: str, rule_log: str | None = None, files_per_date: int = 8
) -> StreamingQuery:
    """Appends everything that is new and stops.

    Rows are projected and filtered without state. Violations are counted on the way, under
    ``silver_clickstream`` in the query's progress; with ``rule_log`` they are kept in that
    folder, see ``RuleCounts``. The sink is partitioned by date, which lets the booking
    window and other date filters prune files. Each batch adds at most ``files_per_date``
    files to a date, instead of one for every task and date; a large backfill takes more.
    """
    spark = clickstream.sparkSession
    counts = [F.count_if(~rule.passes()).alias(rule.name) for rule in CLICKSTREAM_RULES]
    rows = flat_clickstream(clickstream).observe(DATASET, F.count("*").alias("row_count"), *counts)
    part = F.pmod(F.xxhash64("user_id", "timestamp"), F.lit(files_per_date))
    listener = RuleCounts(spark, rule_log, {DATASET: CLICKSTREAM_RULES}) if rule_log else None
    if listener:
        spark.streams.addListener(listener)
    try:
        query = (
            enforce(rows, CLICKSTREAM_RULES)
            .repartition("event_date", part)
            .writeStream.format("parquet")
            .outputMode("append")
            .partitionBy("event_date")
            .option("path", sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if listener:
            listener.wait(query.id)
    finally:
        if listener:
            spark.streams.removeListener(listener)
    return query
