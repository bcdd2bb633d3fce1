"""Continuous changes on top of a serving snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from innmetrics.operators.ranking import top_per_key
from innmetrics.session import folder_exists, list_folders, remove_folder
from innmetrics.sources.serving import BUCKET, DELETED, ServingTable, newest


def stream_changes(
    changes: DataFrame,
    log: str,
    checkpoint: str,
    keys: Sequence[str],
    latest: Sequence[str],
    available_now: bool = True,
    interval: str = "15 seconds",
) -> StreamingQuery:
    """Appends the newest row per key of each batch to a change log.

    A change may have a column ``_deleted``: where it is set, the key is gone, and only its
    key and ``latest`` columns matter. Rewriting the table per batch would cost its touched
    buckets every few seconds, so batches only append; ``current_rows`` resolves them on reading and ``fold`` moves them into the
    table. A batch owns one folder, so running it again after a failure replaces its rows
    and adds none. A fresh checkpoint counts its batches anew, in folders of its own.
    """
    spark = changes.sparkSession
    runs = f"{log}/_runs"
    if not folder_exists(spark, checkpoint):
        started = spark.range(1).select(
            F.lit(checkpoint).alias("checkpoint"), F.lit(uuid.uuid4().hex).alias("run"), F.current_timestamp().alias("at")
        )
        started.coalesce(1).write.mode("append").parquet(runs)
    own = spark.read.parquet(runs).where(F.col("checkpoint") == checkpoint).orderBy(F.desc("at"))
    run = own.first().run

    def append(batch: DataFrame, batch_id: int) -> None:
        order = [F.col(c).desc() for c in latest]
        if DELETED in batch.columns:
            order.append(F.col(DELETED).desc_nulls_last())
        top_per_key(batch, keys, order).write.mode("overwrite").parquet(f"{log}/rows/{run}-{batch_id}")

    writer = changes.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=interval).start()


def current_rows(table: ServingTable, log: str, latest: Sequence[str]) -> DataFrame:
    """The table with all logged changes applied."""
    logged = _logged(table, log)
    if logged is None:
        return table.read()
    found = newest(table.stored(), logged, table.keys, latest)
    return found.where(f"NOT {DELETED}").select(*table.read().columns)


def fold(table: ServingTable, log: str, latest: Sequence[str]) -> int:
    """Moves the logged batches into the buckets they touch and returns how many there were.

    They are removed once the table holds them. If that fails halfway they are applied
    again by the next reader, which changes nothing; batches logged meanwhile stay.
    """
    folders = list_folders(table.spark, f"{log}/rows")
    if folders:
        table.merge(_logged(table, log, folders), latest)
    for folder in folders:
        remove_folder(table.spark, folder)
    return len(folders)


def _logged(table: ServingTable, log: str, folders: list[str] | None = None) -> DataFrame | None:
    folders = list_folders(table.spark, f"{log}/rows") if folders is None else folders
    if not folders:
        return None
    schema = table.stored().drop(BUCKET).schema
    return table.spark.read.schema(schema).parquet(*folders)
