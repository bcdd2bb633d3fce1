"""Snapshots, merges, change streams and incremental ingest."""

import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

import pytest
from market_rows import at, booking, event, rows
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.plans import validate
from innmetrics.plans.pipeline import RULES, Marketplace, current_tables, quality_report, refresh
from innmetrics.session import folder_exists, list_folders, work_folder
from innmetrics.sources import serving
from innmetrics.sources.catalog import describe, list_tables
from innmetrics.sources.serving import DuplicateKeyError, ServingTable, SyncTarget, sync_all
from innmetrics.sources.tables import SCHEMAS
from innmetrics.streaming.changes import current_rows, fold, stream_changes
from innmetrics.streaming.ingest import file_stream, ingest_clickstream
from innmetrics.streaming.rules import logged_violations

_SCHEMA = "k long, at long, v string"


@pytest.fixture
def table(spark):
    root = work_folder(spark, "test")
    schema = f"t{root.rsplit('-', 1)[-1]}"
    serving.create_schema(spark, schema, root)
    return ServingTable(spark, f"{schema}.items", ("k",), root)


@pytest.fixture
def bucketed(table):
    return replace(table, buckets=16)


def frame(spark, *data):
    return spark.createDataFrame(list(data), _SCHEMA)


def test_snapshot_replaces_everything(spark, table):
    table.snapshot(frame(spark, (1, 1, "a"), (2, 1, "b")))
    table.snapshot(frame(spark, (3, 1, "c")))
    assert rows(table.read()) == [(3, 1, "c")]


def test_an_empty_table_has_its_columns(spark, bucketed):
    bucketed.snapshot(frame(spark, (1, 1, "a")).limit(0))
    assert bucketed.read().columns == ["k", "at", "v"] and bucketed.read().count() == 0
    bucketed.merge(frame(spark, (1, 1, "a")), ["at"])
    bucketed.delete(F.col("k") == 1)
    assert bucketed.read().columns == ["k", "at", "v"] and bucketed.read().count() == 0


def test_snapshot_may_read_the_table_it_replaces(spark, table):
    table.snapshot(frame(spark, (1, 1, "a")))
    table.snapshot(table.read().withColumn("v", F.upper("v")))
    assert rows(table.read()) == [(1, 1, "A")]


def test_snapshot_with_new_columns(spark, table):
    table.snapshot(frame(spark, (1, 1, "a")))
    table.snapshot(frame(spark, (1, 1, "a")).withColumn("more", F.lit(5)))
    assert rows(table.read()) == [(1, 1, "a", 5)]


def test_repeated_key_keeps_the_old_version(spark, table):
    table.snapshot(frame(spark, (1, 1, "a")))
    with pytest.raises(DuplicateKeyError, match="k=2"):
        table.snapshot(frame(spark, (2, 1, "x"), (2, 2, "y")))
    assert rows(table.read()) == [(1, 1, "a")]


def test_merge_takes_the_latest_and_ignores_older_changes(spark, table):
    table.snapshot(frame(spark, (1, 5, "a"), (2, 5, "b"), (3, 5, "c")))
    table.merge(frame(spark, (1, 6, "x"), (1, 7, "y"), (2, 4, "old"), (3, 5, "same"), (4, 1, "new")), ["at"])
    assert rows(table.read()) == [(1, 7, "y"), (2, 5, "b"), (3, 5, "same"), (4, 1, "new")]


def test_merge_into_a_missing_table_starts_it(spark, table):
    table.merge(frame(spark, (1, 6, "x"), (1, 7, "y")), ["at"])
    assert rows(table.read()) == [(1, 7, "y")]


def test_row_changes(spark):
    base = frame(spark, (1, 1, "a"), (2, None, "b"))
    assert rows(serving.insert_rows(base, frame(spark, (3, 3, "c"))), "k") == [(1,), (2,), (3,)]
    assert rows(serving.update_rows(base, F.col("at") > 0, {"v": F.lit("z")}), "k", "v") == [(1, "z"), (2, "b")]
    assert rows(serving.delete_rows(base, F.col("at") > 0), "k") == [(2,)]


def test_sync_reports_success_errors_and_skips(spark):
    root = work_folder(spark, "test")
    schema = f"s{root.rsplit('-', 1)[-1]}"
    data = {"good": frame(spark, (1, 1, "a"), (2, 1, "b")), "bad": frame(spark, (1, 1, "a"), (1, 2, "b"))}
    targets = [SyncTarget("good", "good", ("k",), ""), SyncTarget("bad", "bad", ("k",), "")]
    first = sync_all(spark, data, schema, root, targets)
    assert rows(first, "table", "status", "row_count") == [("bad", "error", None), ("good", "success", 2)]
    again = sync_all(spark, data, schema, root, targets[:1], replace=False)
    assert rows(again, "table", "status", "row_count") == [("good", "skipped", 2)]


def test_refresh_writes_every_table_and_counts_violations(market, spark):
    m = market(clickstream=[event(1, 1), event(1, 1, "hover")])
    written, violations = refresh(m, work_folder(spark, "test"))
    assert list(written) == list(RULES)
    assert rows(written["silver_clickstream"], "event") == [("view",)]
    assert rows(written["city_funnel"], "city", "viewers") == [("Porto", 1)]
    assert violations["city_funnel"] == {
        "row_count": 1, "non_negative_viewers": 0, "non_negative_bookers": 0, "logical_funnel": 0
    }


def test_a_failing_constraint_leaves_all_old_tables(market, spark):
    root = work_folder(spark, "test")
    refresh(market(clickstream=[event(1, 1)], bookings=[booking(1, 1, 1)]), root)
    before = {name: rows(table) for name, table in current_tables(spark, root).items()}
    with pytest.raises(Exception, match="required_booking_id"):
        refresh(market(clickstream=[event(2, 2)], bookings=[booking(None, 1, 1)]), root)
    assert {name: rows(table) for name, table in current_tables(spark, root).items()} == before
    assert before["silver_bookings_enriched"] and set(before) == set(RULES)
    refresh(market(clickstream=[event(2, 2)]), root)
    assert rows(current_tables(spark, root)["silver_clickstream"], "user_id") == [(2,)]


def test_refresh_keeps_so_many_versions(market, spark):
    root = work_folder(spark, "test")
    for user in (1, 2, 3):
        refresh(market(clickstream=[event(user, 1)]), root, keep=2)
    assert rows(current_tables(spark, root)["silver_clickstream"], "user_id") == [(3,)]
    versions = [r.version for r in spark.read.parquet(f"{root}/_versions").orderBy("at").collect()]
    assert [folder_exists(spark, f"{root}/{v}") for v in versions] == [False, True, True]


def test_dropped_rows_are_counted_while_writing(market, spark):
    m = market(clickstream=[event(1, 1), event(None, 1), event(1, 1, "hover")], bookings=[booking(1, 1, 1)])
    _, violations = refresh(m, work_folder(spark, "test"))
    found = rows(quality_report(spark, violations))
    assert len(found) == 15
    assert ("silver_clickstream", "valid_user_id", "drop", 2, 1) in found
    assert ("silver_clickstream", "valid_event", "drop", 2, 1) in found
    assert ("silver_bookings_enriched", "required_booking_id", "fail", 1, 0) in found


def test_refresh_on_ingested_events_equals_the_batch(market, spark):
    root = work_folder(spark, "test")
    drops = [[event(1, 1), event(2, 1, "click"), event(None, 2)], [event(2, 2, "hover"), event(3, 2)]]
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, SCHEMAS["clickstream"]).write.parquet(f"{root}/in/drop{n}")
        source = file_stream(spark, f"{root}/in/*", SCHEMAS["clickstream"])
        ingest_clickstream(source, f"{root}/out", f"{root}/checkpoint")
    m = market(clickstream=drops[0] + drops[1], bookings=[booking(1, 1, 1), booking(2, 3, 2)])
    schema = m.silver_clickstream.schema
    streamed = spark.read.schema(schema).parquet(f"{root}/out").select(*schema.names)
    batch, _ = refresh(m, f"{root}/batch")
    followed, _ = refresh(Marketplace(m.tables, m.config), f"{root}/followed", streamed)
    assert {name: rows(t) for name, t in followed.items()} == {name: rows(t) for name, t in batch.items()}


def test_stored_rows_can_be_changed(spark, table):
    table.snapshot(frame(spark, (1, 1, "a"), (2, None, "b")))
    table.insert(frame(spark, (3, 3, "c")))
    with pytest.raises(DuplicateKeyError):
        table.insert(frame(spark, (3, 4, "again")))
    table.update(F.col("at") > 1, {"v": F.lit("z")})
    table.delete(F.col("at") == 1)
    assert rows(table.read()) == [(2, None, "b"), (3, 3, "z")]
    schema, name = table.name.split(".")
    assert [r.table for r in list_tables(spark, schema).where("NOT temporary").collect()] == [name]
    assert [(r.column_name, r.type) for r in describe(spark, table.name).collect()] == [
        ("k", "bigint"), ("at", "bigint"), ("v", "string")
    ]


def files(table):
    """Data files of each bucket."""
    found = {}
    for file in table.stored().inputFiles():
        if "_bucket=-1" in file:  # the file without rows
            continue
        found.setdefault(file.rsplit("/", 2)[-2], set()).add(file)
    return found


def test_changes_leave_untouched_buckets_alone(spark, bucketed):
    bucketed.snapshot(spark.range(1000).selectExpr("id AS k", "1L AS at", "'a' AS v"))
    before = files(bucketed)
    assert len(before) == 16

    def changed(change):
        nonlocal before
        change()
        after = files(bucketed)
        moved = {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}
        before = after
        return len(moved)

    assert changed(lambda: bucketed.merge(frame(spark, (5, 2, "b"), (5, 1, "c")), ["at"])) == 1
    assert changed(lambda: bucketed.insert(frame(spark, (1000, 1, "n")))) == 1
    assert changed(lambda: bucketed.update(F.col("k") == 7, {"v": F.lit("u")})) == 1
    assert changed(lambda: bucketed.delete(F.col("k").isin(8, 9))) <= 2
    assert changed(lambda: bucketed.delete(F.col("k") < -1)) == 0
    expected = {k: (1, "a") for k in range(1001)} | {5: (2, "b"), 1000: (1, "n"), 7: (1, "u")}
    del expected[8], expected[9]
    assert {r.k: (r.at, r.v) for r in bucketed.read().collect()} == expected
    with pytest.raises(ValueError, match="key"):
        bucketed.update(F.col("k") == 7, {"k": F.lit(8)})


def test_a_bucket_without_rows_goes(spark, bucketed):
    bucketed.snapshot(frame(spark, *[(k, 1, "a") for k in range(40)]))
    bucketed.delete(F.col("k") < 39)
    assert rows(bucketed.read()) == [(39, 1, "a")]
    assert len(files(bucketed)) == 1
    bucketed.merge(frame(spark, (3, 1, "again")), ["at"])
    assert rows(bucketed.read()) == [(3, 1, "again"), (39, 1, "a")]


def test_deletes_travel_with_the_changes(spark, bucketed):
    marked = lambda *data: spark.createDataFrame(list(data), _SCHEMA + ", _deleted boolean")
    bucketed.snapshot(frame(spark, (1, 5, "a"), (2, 5, "b"), (3, 5, "c")))
    batch = marked((1, 6, None, True), (2, 4, None, True), (3, 6, "x", None), (4, 6, "n", False), (4, 6, None, True))
    for _ in range(2):  # a replayed batch changes nothing
        bucketed.merge(batch, ["at"])
        assert rows(bucketed.read()) == [(2, 5, "b"), (3, 6, "x")]
    bucketed.merge(marked((1, 5, "late", False)), ["at"])  # older than the deletion
    assert rows(bucketed.read(), "k") == [(2,), (3,)]
    bucketed.merge(marked((1, 7, "back", False)), ["at"])
    assert rows(bucketed.read()) == [(1, 7, "back"), (2, 5, "b"), (3, 6, "x")]
    with pytest.raises(DuplicateKeyError):
        bucketed.insert(frame(spark, (3, 9, "y")))
    bucketed.insert(frame(spark, (4, 1, "inserted")))  # its mark goes
    assert rows(bucketed.read(), "k") == [(1,), (2,), (3,), (4,)]
    bucketed.merge(marked((2, 8, None, True)), ["at"])
    bucketed.forget_deleted(F.col("at") < 9)
    assert bucketed.stored().where("_deleted").count() == 0
    bucketed.merge(marked((2, 1, "older", False)), ["at"])
    assert (2, 1, "older") in rows(bucketed.read())


def test_old_versions_go_but_for_those_in_use(spark, table):
    for n in range(5):
        table.snapshot(frame(spark, (n, 1, "a")))
        if n == 1:
            held = table.location()
            spark.sql(f"CREATE VIEW {table.name}_copy TBLPROPERTIES ('path' = '{held}') AS SELECT * FROM parquet.`{held}`")
    left = list_folders(spark, f"{table.root}/{table.name}")
    assert len(left) == 3 and table.location().rsplit("/", 1)[-1] in {f.rsplit("/", 1)[-1] for f in left}
    assert spark.table(f"{table.name}_copy").count() == 1
    assert rows(table.read(), "k") == [(4,)]


def test_new_columns_appear_without_a_moment_of_no_table(spark, table):
    """A reader that asks all the time finds the old or the new version."""
    table.snapshot(frame(spark, (1, 1, "a")))
    seen, done = [], threading.Event()

    def watch():
        while not done.is_set():
            seen.append(tuple(spark.table(table.name).columns))

    with ThreadPoolExecutor(1) as pool:
        watching = pool.submit(watch)
        table.snapshot(frame(spark, (1, 1, "a")).withColumn("more", F.lit(5)))
        table.snapshot(frame(spark, (1, 1, "a")).drop("v"))
        done.set()
        watching.result()
    assert set(seen) <= {("k", "at", "v"), ("k", "at", "v", "more"), ("k", "at")} and len(seen) > 3


# ------------------------------------------------------------------------------ streams


def test_deletes_in_a_change_stream(spark, bucketed):
    root, log = work_folder(spark, "test"), f"{bucketed.root}/log"
    schema = _SCHEMA + ", _deleted boolean"
    bucketed.snapshot(frame(spark, (1, 5, "a"), (2, 5, "b")))

    def run(name, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{root}/in/{name}")
        stream_changes(file_stream(spark, f"{root}/in/*", schema), log, f"{root}/checkpoint", ["k"], ["at"])
        return rows(current_rows(bucketed, log, ["at"]))

    assert run("one", (1, 6, None, True), (3, 1, "n", False)) == [(2, 5, "b"), (3, 1, "n")]
    assert run("two", (1, 4, "late", False), (2, 6, "z", None)) == [(2, 6, "z"), (3, 1, "n")]
    assert fold(bucketed, log, ["at"]) == 2
    assert rows(bucketed.read()) == [(2, 6, "z"), (3, 1, "n")]
    assert run("three", (1, 5, "later still", False), (3, 2, None, True)) == [(2, 6, "z")]
    assert fold(bucketed, log, ["at"]) == 1 and rows(bucketed.read()) == [(2, 6, "z")]


def test_change_stream_over_several_batches(spark, table):
    root = work_folder(spark, "test")
    table.snapshot(frame(spark, (1, 5, "a"), (2, 5, "b")))

    def run():
        source = file_stream(spark, f"{root}/in/*", _SCHEMA, files_per_batch=1)
        stream_changes(source, f"{root}/log", f"{root}/checkpoint", ["k"], ["at"])
        return rows(current_rows(table, f"{root}/log", ["at"]))

    frame(spark, (1, 6, "x"), (3, 1, "n"), (3, 2, "m")).coalesce(1).write.parquet(f"{root}/in/one")
    assert run() == [(1, 6, "x"), (2, 5, "b"), (3, 2, "m")]
    frame(spark, (1, 4, "late"), (2, 9, "z")).coalesce(1).write.parquet(f"{root}/in/two")
    assert run() == [(1, 6, "x"), (2, 9, "z"), (3, 2, "m")]
    assert run() == [(1, 6, "x"), (2, 9, "z"), (3, 2, "m")]


def test_logged_changes_fold_into_the_table(spark, table):
    root = work_folder(spark, "test")
    table.snapshot(frame(spark, (1, 5, "a"), (2, 5, "b")))
    log = f"{root}/log"
    assert rows(current_rows(table, log, ["at"])) == [(1, 5, "a"), (2, 5, "b")]
    assert fold(table, log, ["at"]) == 0

    def run(checkpoint, *data):
        frame(spark, *data).coalesce(1).write.parquet(f"{root}/{checkpoint}-in/{data[0][1]}")
        stream_changes(
            file_stream(spark, f"{root}/{checkpoint}-in/*", _SCHEMA), log, f"{root}/{checkpoint}", ["k"], ["at"]
        )

    run("one", (1, 6, "x"), (3, 1, "n"))
    run("two", (2, 7, "y"))  # its first batch doesn't replace the one of the other stream
    expected = [(1, 6, "x"), (2, 7, "y"), (3, 1, "n")]
    assert rows(current_rows(table, log, ["at"])) == expected
    assert fold(table, log, ["at"]) == 2
    assert rows(table.read()) == rows(current_rows(table, log, ["at"])) == expected
    run("one", (1, 8, "z"))
    assert fold(table, log, ["at"]) == 1
    assert rows(table.read()) == [(1, 8, "z"), (2, 7, "y"), (3, 1, "n")]


def test_sync_may_merge(spark):
    root = work_folder(spark, "test")
    schema = f"m{root.rsplit('-', 1)[-1]}"
    target = [SyncTarget("items", "items", ("k",), "", mode="merge", latest=("at",))]
    sync_all(spark, {"items": frame(spark, (1, 1, "a"), (2, 1, "b"))}, schema, root, target)
    sync_all(spark, {"items": frame(spark, (1, 2, "c"), (2, 0, "old"))}, schema, root, target)
    assert rows(spark.table(f"{schema}.items")) == [(1, 2, "c"), (2, 1, "b")]


def test_ingest_is_incremental_and_equals_the_batch(market, spark):
    root = work_folder(spark, "test")
    drops = [
        [event(1, 1), event(1, 1, "hover"), event(None, 1)],
        [event(2, None, "search"), event(3, 2, None)],
    ]
    counted = []
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, SCHEMAS["clickstream"]).write.parquet(f"{root}/in/drop{n}")
        source = file_stream(spark, f"{root}/in/*", SCHEMAS["clickstream"])
        query = ingest_clickstream(source, f"{root}/out", f"{root}/checkpoint")
        counted.append(query.lastProgress["observedMetrics"]["silver_clickstream"])
    source = file_stream(spark, f"{root}/in/*", SCHEMAS["clickstream"])
    ingest_clickstream(source, f"{root}/out", f"{root}/checkpoint")
    batch = market(clickstream=drops[0] + drops[1]).silver_clickstream
    streamed = spark.read.schema(batch.schema).parquet(f"{root}/out").select(*batch.columns)
    assert rows(streamed) == rows(batch)
    seen = [(c["row_count"], c["valid_user_id"], c["valid_event"]) for c in counted]
    assert seen == [(3, 1, 1), (2, 0, 1)]


def test_rule_counts_outlive_the_query_and_count_a_batch_once(market, spark):
    root = work_folder(spark, "test")
    drops = [[event(1, 1), event(1, 1, "hover"), event(None, 1)], [event(2, None, "search"), event(None, 2, "hover")]]
    run = lambda: ingest_clickstream(
        file_stream(spark, f"{root}/in/*", SCHEMAS["clickstream"], files_per_batch=1),
        f"{root}/out", f"{root}/checkpoint", f"{root}/rules",
    )
    assert logged_violations(spark, f"{root}/rules") == {}
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, SCHEMAS["clickstream"]).coalesce(1).write.parquet(f"{root}/in/drop{n}")
        run()
    expected = {"silver_clickstream": {"row_count": 5, "valid_user_id": 2, "valid_event": 2}}
    assert logged_violations(spark, f"{root}/rules") == expected
    report = rows(quality_report(spark, logged_violations(spark, f"{root}/rules")))
    assert ("silver_clickstream", "valid_event", "drop", 3, 2) in report
    run()  # nothing new
    for place in (f"{root}/checkpoint/commits", f"{root}/out/_spark_metadata"):  # the last batch failed: it runs again
        Path(f"{place}/1").unlink()
        Path(f"{place}/.1.crc").unlink(missing_ok=True)
    query = run()
    assert [p["batchId"] for p in query.recentProgress if p["numInputRows"]] == [1]
    assert logged_violations(spark, f"{root}/rules") == expected
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_a_batch_adds_few_files_to_a_date(market, spark):
    root = work_folder(spark, "test")
    events = [event(user, 1, when=at(1 + user % 3, 1)) for user in range(300)]
    spark.createDataFrame(events, SCHEMAS["clickstream"]).repartition(12).write.parquet(f"{root}/in/drop")
    source = file_stream(spark, f"{root}/in/*", SCHEMAS["clickstream"])
    ingest_clickstream(source, f"{root}/out", f"{root}/checkpoint", files_per_date=1)
    stored = spark.read.parquet(f"{root}/out")
    assert stored.count() == 300 and len(stored.inputFiles()) == 3


def test_browse_only_rule_is_checked(market):
    m = market(clickstream=[event(200_000, 1), event(200_001, 1), event(5, 1)], bookings=[])
    assert rows(validate.nonbooking_check(m.tables.clickstream, m.tables.bookings, Config())) == [(2, 0)]
