"""Cleaned events, enriched bookings and the shared booking window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.functions.measures import EVENT_TYPES
from innmetrics.operators.quality import DROP, FAIL, Constraint, enforce
from innmetrics.sources.tables import MarketTables

_EVENT_LIST = ", ".join(f"'{e}'" for e in EVENT_TYPES)

CLICKSTREAM_RULES = (
    Constraint("valid_user_id", "user_id IS NOT NULL", DROP),
    Constraint("valid_event", f"event IN ({_EVENT_LIST})", DROP),
)
BOOKING_RULES = (
    Constraint("required_booking_id", "booking_id IS NOT NULL", FAIL),
    Constraint("required_property_id", "property_id IS NOT NULL", DROP),
)


def flat_clickstream(clickstream: DataFrame) -> DataFrame:
    """Events with device, referrer and date as columns; stateless, so it also streams."""
    return clickstream.select(
        "user_id",
        "property_id",
        "event",
        "timestamp",
        F.col("metadata.device").alias("device"),
        F.col("metadata.referrer").alias("referrer"),
        F.to_date("timestamp").alias("event_date"),
    )


def silver_clickstream(clickstream: DataFrame) -> DataFrame:
    return enforce(flat_clickstream(clickstream), CLICKSTREAM_RULES)


def listings(tables: MarketTables) -> DataFrame:
    """Properties with their city and host: the three small tables meet once, so facts
    join a single dimension."""
    return located_properties(tables).join(
        tables.hosts.select(
            "host_id",
            F.col("rating").alias("host_rating"),
            F.col("is_verified").alias("host_verified"),
            F.col("name").alias("host_name"),
        ),
        "host_id",
    )


def located_properties(tables: MarketTables) -> DataFrame:
    """Properties with their city, whether or not the host is known."""
    places = tables.destinations.select("destination_id", F.col("destination").alias("city"), "country")
    properties = tables.properties.select(
        "property_id",
        F.col("title").alias("property_title"),
        "property_type",
        "base_price",
        "destination_id",
        "host_id",
    )
    return properties.join(places, "destination_id")


def paid_bookings(tables: MarketTables) -> DataFrame:
    """One row per booking and payment; bookings without a payment stay, with NULLs."""
    paid = tables.payments.select(
        "booking_id",
        F.col("status").alias("payment_status"),
        "payment_method",
        F.col("amount").alias("payment_amount"),
    )
    booked = tables.bookings.select(
        "booking_id", "user_id", "property_id", "status", "total_amount", "created_at", "check_in", "check_out"
    )
    return booked.join(paid, "booking_id", "left")  # a booking has few payments: no hot key


def bookings_before_rules(tables: MarketTables) -> DataFrame:
    return (
        paid_bookings(tables)
        .join(listings(tables), "property_id")
        .select(
            "booking_id",
            "user_id",
            "property_id",
            F.col("status").alias("booking_status"),
            "total_amount",
            F.col("created_at").alias("booking_created_at"),
            "check_in",
            "check_out",
            F.to_date("created_at").alias("booking_date"),
            "payment_status",
            "payment_method",
            "payment_amount",
            "destination_id",
            "property_type",
            "base_price",
            "host_id",
            "property_title",
            "host_rating",
            "host_verified",
            "host_name",
            "city",
            "country",
        )
    )


def silver_bookings(tables: MarketTables) -> DataFrame:
    return enforce(bookings_before_rules(tables), BOOKING_RULES)


def date_boundaries(silver_clicks: DataFrame) -> DataFrame:
    return silver_clicks.agg(F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))


def in_booking_window(day: str | Column, boundaries: DataFrame) -> Column:
    """Predicate for days within the clickstream's dates, both ends included.

    The bounds are a scalar subquery, so they act as constants of the scan's filter and
    no join is needed; with no clickstream they are NULL and nothing passes.
    """
    column = F.col(day) if isinstance(day, str) else day
    bounds = boundaries.select(F.struct("min_date", "max_date")).scalar()
    return column.between(bounds["min_date"], bounds["max_date"])
