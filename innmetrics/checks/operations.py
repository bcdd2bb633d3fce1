"""Sinks, syncs, streams, scoring and operational checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.checks.registry import Inputs, check
from innmetrics.operators.ranking import top_per_key
from innmetrics.plans import monitoring, scoring, spans
from innmetrics.plans.pipeline import refresh
from innmetrics.sources import serving, testdata
from innmetrics.streaming.changes import current_rows, stream_changes
from innmetrics.streaming.ingest import file_stream, ingest_clickstream

_SPLIT = datetime(2024, 1, 15)
_LATEST = ["ts", "event_id"]

# ------------------------------------------------------------------------ refresh, sync

_DATASETS = (
    ("silver_clickstream", "silver_clicks"),
    ("silver_bookings_enriched", "silver_bookings"),
    ("city_funnel", "city_funnel"),
    ("city_investment", "city_investment"),
    ("property_performance", "property_performance"),
    ("amenity_lift", "amenity_lift"),
    ("amenity_city_top", "(SELECT * FROM amenity_ranks WHERE rank <= 3)"),
    ("device_funnel", "device_funnel"),
    ("device_diagnosis", "device_diagnosis"),
)


@check(
    "mv_refresh",
    " UNION ALL ".join(f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {sql}" for name, sql in _DATASETS),
)
def mv_refresh(i: Inputs):
    written, _ = refresh(i.market, i.folder("refresh"))
    return _row_counts(written)


def _row_counts(written: dict[str, DataFrame]) -> DataFrame:
    lines = None
    for name, rows in written.items():
        line = rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        lines = line if lines is None else lines.unionByName(line)
    return lines


@check(
    "sync_all_summary",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", 'success' AS status, count(*) AS row_count,
                   CAST(NULL AS VARCHAR) AS message FROM {sql}"""
        for name, sql in _DATASETS
        if not name.startswith("silver")
    ),
)
def sync_all_summary(i: Inputs):
    root = i.folder("sync")
    written, _ = refresh(i.market, f"{root}/gold")
    return serving.sync_all(i.spark, written, _schema("gold", root), root)


def _schema(purpose: str, root: str) -> str:
    """A catalog schema of its own for each run."""
    return f"{purpose}_{root.rsplit('-', 1)[-1]}"


def _user_table(i: Inputs, purpose: str) -> tuple[serving.ServingTable, DataFrame]:
    """A published snapshot of the latest event per user before the split day, and all
    later events as its changes."""
    root = i.folder(purpose)
    schema = _schema(purpose, root)
    serving.create_schema(i.spark, schema, root)
    table = serving.ServingTable(i.spark, f"{schema}.latest_event", ("user_id",), root, buckets=8)
    events = i.raw("events")
    before = F.col("ts") < F.lit(_SPLIT)
    table.snapshot(top_per_key(events.where(before), ["user_id"], [F.col(c).desc() for c in _LATEST]))
    return table, events.where(~before)


@check("snapshot_sync", "SELECT * FROM user_snapshot", doubles="value")
def snapshot_sync(i: Inputs):
    table, _ = _user_table(i, "snapshot")
    return table.read()


@check("incremental_upsert", "SELECT * FROM user_latest", doubles="value")
def incremental_upsert(i: Inputs):
    table, changes = _user_table(i, "upsert")
    table.merge(changes, _LATEST)
    return table.read()


@check("stream_upsert", "SELECT * FROM user_latest", doubles="value")
def stream_upsert(i: Inputs):
    table, _ = _user_table(i, "changes")
    source = file_stream(i.spark, f"{i.sf_dir.rstrip('/')}/event*.parquet", testdata.RAW_SCHEMAS["events"])
    log = f"{table.root}/log"
    stream_changes(source.where(F.col("ts") >= F.lit(_SPLIT)), log, f"{table.root}/checkpoint", table.keys, _LATEST)
    return current_rows(table, log, _LATEST)


@check("dedup_latest", "SELECT * FROM user_latest", doubles="value")
def dedup_latest(i: Inputs):
    return top_per_key(i.raw("events"), ["user_id"], [F.col(c).desc() for c in _LATEST])


@check("stream_silver_clickstream", "SELECT * FROM silver_clicks")
def stream_silver_clickstream(i: Inputs):
    source = file_stream(i.spark, f"{i.sf_dir.rstrip('/')}/event*.parquet", testdata.RAW_SCHEMAS["events"])
    root = i.folder("ingest")
    ingest_clickstream(testdata.clickstream(source), f"{root}/silver", f"{root}/checkpoint")
    return i.spark.read.schema(i.market.silver_clickstream.schema).parquet(f"{root}/silver")


@check(
    "table_crud",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
       FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
             UNION ALL
             SELECT 1000000000 + s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)
       WHERE NOT (c_acctbal < 0 AND c_mktsegment <> 'BUILDING')""",
    doubles="c_acctbal",
    bigints="c_nationkey",
)
def table_crud(i: Inputs):
    """Insert suppliers as customers, delete indebted ones, then credit one segment."""
    added = i.raw("supplier").select(
        (F.lit(1_000_000_000) + F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    root = i.folder("crud")
    schema = _schema("crud", root)
    serving.create_schema(i.spark, schema, root)
    table = serving.ServingTable(i.spark, f"{schema}.customers", ("c_custkey",), root, buckets=8)
    table.snapshot(i.raw("customer"))
    table.insert(added)
    building = F.col("c_mktsegment") == "BUILDING"
    table.delete((F.col("c_acctbal") < 0) & ~building)
    table.update(building, {"c_acctbal": F.col("c_acctbal") + 100})
    return table.read()


# ------------------------------------------------------------------- operational checks


@check(
    "freshness_check",
    """SELECT date_diff('second', max(ts), TIMESTAMP '2024-01-31 06:00:00') // 3600 AS hours_since_update,
              date_diff('second', max(ts), TIMESTAMP '2024-01-31 06:00:00') // 3600 > 6 AS alert FROM events""",
)
def freshness_check(i: Inputs):
    return monitoring.freshness_check(i.raw("events"), "ts", F.lit("2024-01-31 06:00:00").cast("timestamp_ntz"))


@check(
    "duration_check",
    "SELECT event_id AS run_id, value * 20 AS duration_s FROM events WHERE value * 20 > 7200",
    doubles="duration_s",
)
def duration_check(i: Inputs):
    runs = i.raw("events").select(F.col("event_id").alias("run_id"), (F.col("value") * 20).alias("duration_s"))
    return monitoring.duration_check(runs)


@check(
    "trace_search",
    """SELECT event_id AS trace_id, ts AS timestamp, 'ERROR' AS state, value AS execution_time_ms, user_id
       FROM events WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-05' AND user_id <> 1
       ORDER BY value DESC, event_id LIMIT 100""",
    doubles="execution_time_ms",
)
def trace_search(i: Inputs):
    traces = i.raw("events").select(
        F.col("event_id").alias("trace_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("state"),
        F.col("value").alias("execution_time_ms"),
        "user_id",
    )
    return monitoring.trace_search(
        traces,
        where=[
            F.col("state") == "ERROR",
            F.col("timestamp") > F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"),
            F.col("user_id") != 1,
        ],
        order=[F.col("execution_time_ms").desc(), F.col("trace_id")],
        limit=100,
    )


@check(
    "span_explode",
    """SELECT conv_id, turn, unnest(generate_series(0, len(lines) - 1)) AS span_no, role AS span_type,
              unnest(lines) AS content
       FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations)""",
)
def span_explode(i: Inputs):
    """Every turn is a trace whose lines are its spans."""
    span = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.col("role").alias("span_type"), line.alias("content"))
    )
    traces = i.raw("conversations").select("conv_id", "turn", span.alias("spans"))
    return monitoring.span_explode(traces, ["conv_id", "turn"])


@check(
    "span_tree",
    """SELECT s.conv_id, s.turn, w.depth, w.path, s.duration - coalesce(b.below, 0) AS own_time
       FROM (SELECT conv_id, turn, strlen(text) AS duration FROM conversations) AS s
       JOIN (WITH RECURSIVE ways(conv_id, turn, depth, path) AS (
               SELECT conv_id, turn, CAST(0 AS BIGINT), CAST(turn AS VARCHAR) FROM conversations WHERE turn = 0
               UNION ALL
               SELECT c.conv_id, c.turn, w.depth + 1, w.path || '/' || c.turn
               FROM conversations AS c JOIN ways AS w ON w.conv_id = c.conv_id AND c.turn > 0 AND (c.turn - 1) // 2 = w.turn)
             SELECT * FROM ways) AS w USING (conv_id, turn)
       LEFT JOIN (SELECT conv_id, (turn - 1) // 2 AS turn, sum(strlen(text)) AS below
                  FROM conversations WHERE turn > 0 GROUP BY 1, 2) AS b USING (conv_id, turn)""",
    bigints="own_time",
)
def span_tree(i: Inputs):
    """Every turn but the first answers an earlier one of its conversation."""
    turns = i.raw("conversations").select(
        "conv_id",
        "turn",
        F.expr("if(turn > 0, (turn - 1) div 2, NULL)").cast("int").alias("answered"),
        F.octet_length("text").cast("bigint").alias("duration"),
    )
    turns = turns.withColumn("answered", F.col("answered").cast(turns.schema["turn"].dataType))
    tree = spans.span_tree(turns, ["conv_id"], "turn", "answered", "duration")
    return tree.select("conv_id", "turn", "depth", "path", "own_time")


@check(
    "feedback_summary",
    """SELECT source, count(*) AS answers, avg(quality) AS mean_quality, avg(toxic) AS mean_toxic
       FROM labels JOIN documents USING (doc_id) GROUP BY source""",
    doubles="mean_quality mean_toxic",
)
def feedback_summary(i: Inputs):
    feedback = i.raw("labels").join(i.raw("documents").select("doc_id", "source"), "doc_id")
    return monitoring.feedback_summary(feedback, "source", ["quality", "toxic"])


@check(
    "expectation_match",
    """SELECT event_type AS response, count(*) AS answers,
              count(*) FILTER (WHERE CASE WHEN user_id % 2 = 0 THEN event_type IN ('click', 'view')
                                          ELSE event_type = 'purchase' END) AS matches
       FROM events GROUP BY 1""",
)
def expectation_match(i: Inputs):
    acceptable = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("click"), F.lit("view"))).otherwise(
        F.array(F.lit("purchase"))
    )
    rows = i.raw("events").select(F.col("event_type").alias("response"), acceptable.alias("acceptable"))
    return (
        monitoring.expectation_match(rows, "response", "acceptable")
        .groupBy("response")
        .agg(F.count("*").alias("answers"), F.count_if("matched").alias("matches"))
    )


@check(
    "low_rating_cases",
    """SELECT property_id, rating, count(*) AS cases FROM reviews WHERE rating < 3 GROUP BY ALL""",
    doubles="rating",
)
def low_rating_cases(i: Inputs):
    cases = monitoring.low_rating_cases(i.tables.reviews)
    return cases.groupBy("property_id", "rating").agg(F.count("*").alias("cases"))


@check("eval_dataset_count", "SELECT lang, count(*) AS num_records FROM documents GROUP BY lang")
def eval_dataset_count(i: Inputs):
    return monitoring.record_count(i.raw("documents"), "lang")


@check(
    "table_preview",
    "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    doubles="c_acctbal",
    bigints="c_nationkey",
)
def table_preview(i: Inputs):
    return monitoring.table_preview(i.raw("customer"), ["c_custkey"])


# ------------------------------------------------------------------------------- scoring


@check(
    "batch_score",
    """SELECT vec_id, CASE WHEN vec_id % 97 <> 0 THEN list_sum(list_transform(range(len(embedding)),
                  lambda p: CAST(embedding[p + 1] AS DOUBLE) * ((p % 7) - 3) / 10.0)) END AS score,
              vec_id % 97 = 0 AS failed
       FROM embeddings""",
    doubles="score",
)
def batch_score(i: Inputs):
    """Some vectors are missing; only their own rows may fail."""
    rows = i.raw("embeddings").withColumn("embedding", F.expr("if(vec_id % 97 = 0, NULL, embedding)"))
    scored = scoring.batch_score(rows, "vec_id", "embedding", scoring.linear_score)
    return scored.select("vec_id", "score", F.col("error").isNotNull().alias("failed"))


@check(
    "scorer_mean",
    """SELECT avg(CASE WHEN (n_chars > 500) = (quality = 1) THEN 1.0 ELSE 0.0 END) AS length_predicts_quality,
              count(*) AS scored_rows
       FROM documents JOIN labels USING (doc_id)""",
    doubles="length_predicts_quality",
)
def scorer_mean(i: Inputs):
    rows = (
        i.raw("documents")
        .select("doc_id", "n_chars")
        .join(i.raw("labels").select("doc_id", "quality"), "doc_id")
        .select((F.col("n_chars") > 500).alias("prediction"), (F.col("quality") == 1).alias("target"))
    )
    return scoring.scorer_mean(rows, "prediction", "target", "length_predicts_quality", scoring.exact_match)
