"""Every registered query against its SQL in DuckDB."""

from pathlib import Path

import pytest
from compare import TABLES, compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from innmetrics.checks.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["last_touch", "device_funnel", "join_interval_24h", "temporal_distribution"])
def test_a_user_with_most_events_gives_the_same_results(spark, name, tmp_path):
    """Two thirds of all events, at their own times, are those of one user."""
    for table in TABLES:
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        if table == "events":
            rows = rows.withColumn("user_id", F.expr("if(event_id % 3 > 0, 1, user_id)"))
        rows.coalesce(1).write.parquet(f"{tmp_path}/parts/{table}")
        next(Path(f"{tmp_path}/parts/{table}").glob("part-*.parquet")).rename(f"{tmp_path}/{table}.parquet")
    found = entry.queries()[name](spark, str(tmp_path))
    assert compare(found, duck(str(tmp_path)), entry.oracle_sql()[name]) == []


def test_entry_returns_rows(spark):
    funnel = entry.entry(spark)
    assert funnel.columns[:2] == ["city", "event_date"]
    assert funnel.count() > 0
