"""First looks at bookings and traffic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.operators.distinct import count_distinct
from innmetrics.operators.share import count_shares


def bookings_temporal(bookings: DataFrame, months: int = 12) -> DataFrame:
    """Bookings, users and properties per month, latest months first."""
    return (
        count_distinct(
            bookings.withColumn("month", F.date_trunc("month", "created_at")),
            ["month"],
            {"unique_users": "user_id", "unique_properties": "property_id"},
            {"booking_count": "*"},
        )
        .select("month", "booking_count", "unique_users", "unique_properties")
        .orderBy(F.col("month").desc())
        .limit(months)
    )


def user_booking_frequency(bookings: DataFrame) -> DataFrame:
    """How many users have how many bookings."""
    per_user = bookings.groupBy("user_id").agg(F.count("*").alias("bookings_per_user"))
    return per_user.groupBy("bookings_per_user").agg(F.count("*").alias("user_count")).orderBy("bookings_per_user")


def property_popularity(bookings: DataFrame, top: int = 20) -> DataFrame:
    return (
        bookings.groupBy("property_id")
        .agg(F.count("*").alias("booking_count"), F.countDistinct("user_id").alias("unique_users"))
        .orderBy(F.col("booking_count").desc(), "property_id")
        .limit(top)
    )


def sample_bookings(bookings: DataFrame, since: datetime = datetime(2025, 1, 1), top: int = 10) -> DataFrame:
    """Latest bookings since a day, with the days between booking and arrival."""
    return (
        bookings.where(F.col("created_at") >= F.lit(since))
        .select(
            "booking_id",
            "user_id",
            "property_id",
            "created_at",
            "check_in",
            "check_out",
            "status",
            F.datediff("check_in", F.to_date("created_at")).alias("days_advance_booking"),
        )
        .orderBy(F.col("created_at").desc(), "booking_id")
        .limit(top)
    )


def clickstream_patterns(clickstream: DataFrame, top: int = 20) -> DataFrame:
    return (
        clickstream.groupBy(
            "event", F.col("metadata.device").alias("device"), F.col("metadata.referrer").alias("referrer")
        )
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "event", "device", "referrer")
        .limit(top)
    )


def event_distribution(clickstream: DataFrame) -> DataFrame:
    return count_shares(clickstream, ["event"]).orderBy(F.col("count").desc(), "event")


def metadata_distribution(clickstream: DataFrame, *parts: str, top: int | None = None) -> DataFrame:
    """Shares of device, referrer or their combinations."""
    rows = clickstream.select(*[F.col(f"metadata.{part}").alias(part) for part in parts])
    shares = count_shares(rows, list(parts)).orderBy(F.col("count").desc(), *parts)
    return shares if top is None else shares.limit(top)
