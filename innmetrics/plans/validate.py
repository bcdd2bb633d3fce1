"""Checks of a clickstream against the bookings it belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.measures import HUNDRED, percent_share
from innmetrics.operators.distinct import count_distinct
from innmetrics.operators.prefix import count_before, count_within
from innmetrics.operators.slots import HOUR_MICROS
from innmetrics.plans.synth import browse_floor

_PAIR = ["user_id", "property_id"]

# Lead-time buckets in reporting order; each ends before so many hours.
LEAD_BUCKETS = (
    ("< 1 hour", 1),
    ("1-24 hours", 24),
    ("1-7 days", 168),
    ("1-4 weeks", 672),
    ("> 4 weeks", None),
)


def _timed_events(clickstream: DataFrame) -> DataFrame:
    return clickstream.select(*_PAIR, "event", F.unix_micros("timestamp").alias("at"))


def _probes(bookings: DataFrame, *bounds: tuple[str, Column]) -> DataFrame:
    """One row per booking and named time bound."""
    parts = [F.struct(F.lit(name).alias("bound_name"), at.alias("bound")) for name, at in bounds]
    return bookings.select("booking_id", *_PAIR, "created_at", F.inline(F.array(*parts)))


def _through(moment: str = "created_at") -> Column:
    """Exclusive bound that still takes in events at the moment itself."""
    return F.unix_micros(moment) + 1


def event_counts(bookings: DataFrame, clickstream: DataFrame, days: int = 30) -> DataFrame:
    """Per booking the events of the same user and property in the days before it
    (``event_count``) and after it (``later_events``), from one table of running counts."""
    probes = _probes(
        bookings,
        ("until", _through()),
        ("from", F.unix_micros(F.col("created_at") - F.expr(f"INTERVAL {days} DAYS"))),
    )
    counts = {"named": F.when(F.col("event").isNotNull(), 1).otherwise(0), "any_event": F.lit(1)}
    counted = count_before(probes, _timed_events(clickstream), _PAIR, bound="bound", at="at", counts=counts)
    until = F.col("bound_name") == "until"
    return counted.groupBy("booking_id", *_PAIR, "created_at").agg(
        F.sum(F.when(until, F.col("named")).otherwise(-F.col("named"))).alias("event_count"),
        F.sum(F.when(until, F.col("any_event_ever") - F.col("any_event"))).alias("later_events"),
    )


def events_per_booking(bookings: DataFrame, clickstream: DataFrame) -> DataFrame:
    return summary_of_counts(event_counts(bookings, clickstream))


def summary_of_counts(counted: DataFrame) -> DataFrame:
    events = F.col("event_count")
    return counted.agg(
        F.count("*").alias("total_bookings"),
        F.round(F.avg(events), 2).alias("avg_events_per_booking"),
        F.min(events).alias("min_events"),
        F.max(events).alias("max_events"),
        F.count_if(events == 0).alias("bookings_without_events"),
        F.count_if(events.between(5, 20)).alias("bookings_in_target_range"),
    )


def temporal_distribution(bookings: DataFrame, clickstream: DataFrame) -> DataFrame:
    """Events up to a booking by whole-second lead time, in buckets.

    Cumulative counts at the bucket limits replace the pairs of event and booking.
    """
    limits = [(name, hours) for name, hours in LEAD_BUCKETS if hours is not None]
    bounds = [("all", _through())]
    for name, hours in limits:
        bounds.append((name, (F.unix_seconds("created_at") - hours * 3600 + 1) * 1_000_000))
    counted = count_before(_probes(bookings, *bounds), _timed_events(clickstream), _PAIR, bound="bound", at="at")

    def at(name: str) -> Column:
        return F.sum(F.when(F.col("bound_name") == name, F.col("events_before")).otherwise(0))

    per_booking = counted.groupBy("booking_id", *_PAIR).agg(*[at(name).alias(name) for name, _ in bounds])
    reached = ["all", *[name for name, _ in limits]]
    lines = []
    for place, (name, hours) in enumerate(LEAD_BUCKETS):
        earlier = F.col(f"`{name}`") if hours is not None else F.lit(0)
        count = F.col(f"`{reached[place]}`") - earlier
        lines.append(
            F.struct(F.lit(place).alias("place"), F.lit(name).alias("time_window"), count.alias("events"))
        )
    buckets = (
        per_booking.select("booking_id", F.inline(F.array(*lines)))
        .where("events > 0")
        .groupBy("place", "time_window")
        .agg(F.sum("events").alias("event_count"), F.count("booking_id").alias("booking_count"))
    )
    line = F.struct("place", "time_window", "event_count", "booking_count")
    report = buckets.agg(F.collect_list(line).alias("lines"), F.sum("event_count").alias("total"))  # five lines at most
    return (
        report.select("total", F.inline("lines"))
        .withColumn("percentage", percent_share(F.col("event_count"), F.col("total")))
        .orderBy("place")
        .drop("place", "total")
    )


def invalid_events(bookings: DataFrame, clickstream: DataFrame) -> DataFrame:
    """Pairs of a booking and a later event of the same user and property."""
    probes = _probes(bookings, ("until", _through()))
    counted = count_before(probes, _timed_events(clickstream), _PAIR, bound="bound", at="at")
    later = F.col("events_before_ever") - F.col("events_before")
    return counted.agg(F.coalesce(F.sum(later), F.lit(0)).alias("invalid_events"))


def touches_in_window(bookings: DataFrame, touches: DataFrame, hours: int = 24) -> DataFrame:
    """Touches of the booking's user in the hours before it, both ends included, for
    bookings that have any."""
    probes = bookings.select("booking_id", "user_id", F.unix_micros("created_at").alias("moment"))
    events = touches.select("user_id", F.unix_micros("timestamp").alias("at"))
    counted = count_within(probes, events, ["user_id"], "moment", "at", hours * HOUR_MICROS, ["booking_id", "user_id"])
    return counted.where("events > 0").select("booking_id", F.col("events").alias("touches"))


def timestamp_range_compare(clickstream: DataFrame, bookings: DataFrame) -> DataFrame:
    def summary(rows: DataFrame, source: str, at: str) -> DataFrame:
        counted = traffic_summary(rows, at, "earliest_event", "latest_event")
        return counted.select(F.lit(source).alias("source"), "*")

    return summary(clickstream, "synthetic", "timestamp").unionByName(summary(bookings, "bookings", "created_at"))


def clickstream_summary(clickstream: DataFrame) -> DataFrame:
    return traffic_summary(clickstream, "timestamp", "min_timestamp", "max_timestamp")


def traffic_summary(rows: DataFrame, at: str, first: str, last: str) -> DataFrame:
    """Rows, users, properties and the first and last moment."""
    return count_distinct(
        rows,
        [],
        {"unique_users": "user_id", "unique_properties": "property_id"},
        {"total_events": "*"},
        {first: ("min", at), last: ("max", at)},
    ).select("total_events", "unique_users", "unique_properties", first, last)


def user_segmentation(clickstream: DataFrame, bookings: DataFrame) -> DataFrame:
    """Viewers with and without a booking, and the share with one.

    Both tables are stacked and reduced to one row per user, which needs one shuffle and
    no join of user lists.
    """
    users = _user_flags(clickstream, bookings)
    viewers, bookers = F.col("viewers"), F.col("bookers")
    return users.agg(
        F.count_if("viewed").alias("viewers"), F.count_if(F.col("viewed") & F.col("booked")).alias("bookers")
    ).select(
        viewers.alias("total_viewers"),
        bookers.alias("users_who_booked"),
        (viewers - bookers).alias("users_who_didnt_book"),
        percent_share(bookers, viewers).alias("conversion_rate_pct"),
    )


def conversion_rate(clickstream: DataFrame, bookings: DataFrame) -> DataFrame:
    return user_segmentation(clickstream, bookings).select(
        "total_viewers",
        F.col("users_who_booked").alias("bookers"),
        F.col("conversion_rate_pct").alias("conversion_rate"),
    )


def nonbooking_check(clickstream: DataFrame, bookings: DataFrame, config: Config) -> DataFrame:
    """Browse-only users, and how many of them have a booking against the rules."""
    users = _user_flags(clickstream, bookings).where(F.col("user_id") >= browse_floor(bookings, config))
    return users.agg(
        F.count_if("viewed").alias("non_booking_viewers"),
        F.count_if(F.col("viewed") & F.col("booked")).alias("non_booking_users_with_bookings"),
    )


def _user_flags(clickstream: DataFrame, bookings: DataFrame) -> DataFrame:
    viewed = clickstream.select("user_id", F.lit(True).alias("viewed"), F.lit(False).alias("booked"))
    booked = bookings.select("user_id", F.lit(False).alias("viewed"), F.lit(True).alias("booked"))
    return (
        viewed.unionByName(booked)
        .where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(F.bool_or("viewed").alias("viewed"), F.bool_or("booked").alias("booked"))
    )


def events_by_user_type(clickstream: DataFrame, bookings: DataFrame, config: Config) -> DataFrame:
    browse_only = F.col("user_id") >= browse_floor(bookings, config)
    users = (
        clickstream.groupBy("user_id")
        .agg(F.count("*").alias("events"))
        .groupBy(F.when(browse_only, "Non-Booking User").otherwise("Booking User").alias("user_type"))
        .agg(F.sum("events").alias("total_events"), F.count("user_id").alias("unique_users"))
    )
    average = F.round(F.try_divide("total_events", "unique_users"), 2)
    return users.withColumn("avg_events_per_user", average).orderBy("user_type")


def schema_compare(template: DataFrame, other: DataFrame) -> DataFrame:
    """Columns and types of two tables side by side, with the filled values of each."""

    def described(rows: DataFrame, side: str) -> DataFrame:
        filled = rows.agg(*[F.count(F.col(f.name)).alias(f.name) for f in rows.schema.fields])
        lines = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias(f"{side}_type"),
                F.col(f.name).alias(f"{side}_filled"),
            )
            for f in rows.schema.fields
        ]
        return filled.select(F.inline(F.array(*lines)))

    both = described(template, "template").join(described(other, "other"), "column_name", "full")
    return both.withColumn("same_type", F.col("template_type").eqNullSafe(F.col("other_type")))


def validation_verdicts(clickstream: DataFrame, bookings: DataFrame, config: Config) -> DataFrame:
    """(check, passed, measured) for the acceptance rules of generated traffic."""
    share_of_views = clickstream.agg(
        F.round(F.try_divide(F.count_if(F.col("event") == "view") * F.lit(HUNDRED), F.count("*")), 2).alias("m")
    ).select(F.lit("all_events_are_views"), F.col("m") == 100, F.col("m"))
    events = F.col("event_count")
    per_booking = event_counts(bookings, clickstream).agg(
        F.count_if(events == 0).alias("without"),
        F.min(events).alias("least"),
        F.max(events).alias("most"),
        F.coalesce(F.sum("later_events"), F.lit(0)).alias("later"),
    )
    per_booking = per_booking.select(
        F.inline(
            F.array(
                _verdict("all_bookings_have_events", F.col("without") == 0, "without"),
                _verdict("at_least_5_events", F.col("least") >= 5, "least"),
                _verdict("at_most_20_events", F.col("most") <= 20, "most"),
                _verdict("no_events_after_booking", F.col("later") == 0, "later"),
            )
        )
    )
    rate = user_segmentation(clickstream, bookings).select(
        F.lit("conversion_42_to_46"), F.col("conversion_rate_pct").between(42, 46), F.col("conversion_rate_pct")
    )
    browse = nonbooking_check(clickstream, bookings, config).select(
        F.lit("browse_only_users_never_book"),
        F.col("non_booking_users_with_bookings") == 0,
        F.col("non_booking_users_with_bookings"),
    )
    columns = ("check", "passed", "measured")
    parts = [
        part.toDF(*columns).select("check", "passed", F.col("measured").cast("double").alias("measured"))
        for part in (share_of_views, per_booking, rate, browse)
    ]
    verdicts = parts[0]
    for part in parts[1:]:
        verdicts = verdicts.unionByName(part)
    return verdicts


def _verdict(check: str, passed: Column, measured: str) -> Column:
    return F.struct(
        F.lit(check).alias("check"), passed.alias("passed"), F.col(measured).cast("double").alias("measured")
    )
