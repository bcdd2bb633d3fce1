"""What the catalog holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """table, kind (MANAGED, EXTERNAL or VIEW) and whether it is temporary."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(schema)]
    return spark.createDataFrame(rows, "table STRING, kind STRING, temporary BOOLEAN").orderBy("table")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """place, column_name, type, nullable and is_partition of a table's columns."""
    rows = [
        (place, c.name, c.dataType, c.nullable, c.isPartition)
        for place, c in enumerate(spark.catalog.listColumns(table))
    ]
    return spark.createDataFrame(
        rows, "place INT, column_name STRING, type STRING, nullable BOOLEAN, is_partition BOOLEAN"
    ).orderBy("place")
