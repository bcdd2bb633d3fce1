"""Overwriting some parts of a stored table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from innmetrics.session import list_files, remove_folder


def overwrite_parts(rows: DataFrame, path: str, column: str, values: Iterable) -> None:
    """Replaces the folders ``column=value`` of a stored table by the rows, which may be
    read from them. Of the values that no row has, the folder is removed; the files of all
    other folders stay. A large part is written by several tasks, a small one by one."""
    spark = rows.sparkSession
    folders = [f"{path}/{column}={value}" for value in values]
    before = [list_files(spark, folder) for folder in folders]
    writer = rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
    for folder, old in zip(folders, before):
        if list_files(spark, folder) == old:  # nothing was written to it
            remove_folder(spark, folder)
