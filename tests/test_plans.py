"""Properties of the physical plans that scale depends on."""

import re

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from innmetrics.checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

#: Queries that write and read back; their plans are those of the datasets they write.
WRITING = {
    "mv_refresh", "sync_all_summary", "snapshot_sync", "incremental_upsert", "stream_upsert",
    "stream_silver_clickstream", "table_crud", "quality_report", "incremental_city_funnel", "city_funnel_weekly",
    "span_tree",
}
#: Queries on generated traffic write it first.
ON_TRAFFIC = {"events_per_booking", "temporal_distribution", "invalid_events", "validation_verdicts"}


PLANS: dict[str, str] = {}


def plan(spark, name: str) -> str:
    if name not in PLANS:
        frame = QUERIES[name](spark, SF_DIR)
        PLANS[name] = frame._jdf.queryExecution().executedPlan().toString()
    return PLANS[name]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_crossing_of_rows(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING - {"batch_score", "scorer_mean"}))
def test_no_python_in_the_plan(spark, name):
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan(spark, name))


def test_scans_read_only_needed_columns(spark):
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan(spark, "referrer_distribution")
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,purchase))]" in plan(
        spark, "referrer_distribution"
    )
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan(
        spark, "filter_compound"
    )


def test_whole_window_is_never_one_task(spark):
    """A window without partitions would pull its input into one task; the one allowed
    holds the bucket sizes of the dense index."""
    for name in sorted(set(QUERIES) - WRITING):
        for window in re.findall(r"\bWindow \[.*", plan(spark, name)):
            partitions = re.search(r"\], \[(.*?)\]", window)
            if "_size" not in window:
                assert partitions and partitions.group(1), (name, window[:200])


@pytest.mark.parametrize(
    "name",
    ["last_touch", "join_interval_24h", "device_funnel", "synth_nonbooking_events", "property_performance"],
)
def test_building_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"building-{name}", name)
    QUERIES[name](spark, SF_DIR)
    assert not tracker.getJobIdsForGroup(f"building-{name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["clickstream_summary", "timestamp_range_compare", "bookings_temporal"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in plan(spark, name)


@pytest.mark.parametrize("name", sorted(ON_TRAFFIC))
def test_checks_of_traffic_read_it_a_few_times(spark, name):
    assert len(re.findall(r"Scan parquet", plan(spark, name))) <= 40
