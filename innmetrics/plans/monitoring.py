"""Operational checks and evaluation tables: freshness, run length, traces, feedback."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def freshness_check(rows: DataFrame, updated_at: str, now: Column, limit_hours: int = 6) -> DataFrame:
    """Full hours since the last update, and whether that calls for an alert."""
    hours = F.timestamp_diff("HOUR", F.max(updated_at), now)
    return rows.agg(hours.alias("hours_since_update")).withColumn(
        "alert", F.col("hours_since_update") > limit_hours
    )


def duration_check(runs: DataFrame, limit_seconds: int = 7200) -> DataFrame:
    """Runs over the time limit."""
    return runs.where(F.col("duration_s") > limit_seconds)


def trace_search(
    traces: DataFrame,
    where: Sequence[Column] = (),
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Traces that meet all conditions, in order, at most ``limit`` of them."""
    for condition in where:
        traces = traces.where(condition)
    if order:
        traces = traces.orderBy(*order)
    return traces if limit is None else traces.limit(limit)


def span_explode(traces: DataFrame, keys: Sequence[str], spans: str = "spans") -> DataFrame:
    """One row per span, with its position; traces without spans give no row."""
    return traces.select(*keys, F.posexplode(spans).alias("span_no", "span")).select(
        *keys, F.col("span_no").cast("bigint").alias("span_no"), "span.*"
    )


def feedback_summary(feedback: DataFrame, source: str, scores: Sequence[str]) -> DataFrame:
    """Answers and mean score per feedback source."""
    return feedback.groupBy(source).agg(
        F.count("*").alias("answers"), *[F.avg(score).alias(f"mean_{score}") for score in scores]
    )


def expectation_match(rows: DataFrame, response: str, acceptable: str) -> DataFrame:
    """Marks responses that equal any of the row's acceptable answers."""
    matched = F.coalesce(F.array_contains(acceptable, F.col(response)), F.lit(False))
    return rows.withColumn("matched", matched)


def low_rating_cases(ratings: DataFrame, rating: str = "rating", below: float = 3) -> DataFrame:
    """Ratings that become test cases."""
    return ratings.where(F.col(rating) < below)


def record_count(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("num_records"))


def table_preview(rows: DataFrame, order: Sequence[str], limit: int = 10) -> DataFrame:
    return rows.orderBy(*order).limit(limit)


def json_field(text: str, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}")


def json_merge(text: str, added: Mapping[str, object]) -> Column:
    """The JSON object in ``text`` with the fields of ``added``, which win, as JSON text.

    Values keep their types on both sides: numbers, booleans, null, arrays and nested
    objects; a field of both is replaced as a whole. Keys come in order. A null text, or
    one that is no JSON object, gives null.
    """
    fields = "map<string,variant>"
    new = F.variant_get(F.parse_json(F.lit(json.dumps(added))), "$", fields)
    own = F.try_variant_get(F.try_parse_json(text), "$", fields)
    kept = F.map_filter(own, lambda name, _: ~F.map_contains_key(new, name))
    return F.to_json(F.to_variant_object(F.map_concat(kept, new)))
