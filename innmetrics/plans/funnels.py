"""Daily city funnel and weekly device funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.measures import is_completed, is_confirmed, is_view, safe_rate
from innmetrics.operators.distinct import count_members
from innmetrics.operators.last_touch import last_touch
from innmetrics.operators.quality import Constraint
from innmetrics.operators.ranking import top_per_key
from innmetrics.plans.silver import in_booking_window, located_properties
from innmetrics.sources.tables import MarketTables

FUNNEL_RULES = (
    Constraint("non_negative_viewers", "viewers >= 0"),
    Constraint("non_negative_bookers", "initiated_bookers >= 0 AND confirmed_bookers >= 0 AND completers >= 0"),
    Constraint("logical_funnel", "initiated_bookers >= confirmed_bookers AND confirmed_bookers >= completers"),
)

EVENT_COLUMNS = {"viewers": "view", "clickers": "click", "searchers": "search", "filterers": "filter"}
STAGES = ("initiated_bookers", "confirmed_bookers", "completers")


def stage_flags(today: Column) -> dict[str, Column]:
    return {
        "initiated_bookers": F.lit(True),
        "confirmed_bookers": is_confirmed(),
        "completers": is_completed(today),
    }


def city_traffic(silver_clicks: DataFrame, places: DataFrame) -> DataFrame:
    """Clean events with the city of their property; events of unknown properties drop out."""
    return silver_clicks.join(places.select("property_id", "city"), "property_id")


def city_funnel(
    tables: MarketTables, silver_clicks: DataFrame, silver_bookings: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Per city and day: distinct users per event type and per booking stage.

    Traffic and bookings are tagged and stacked, so one aggregation counts every stage
    where joining separate counts would shuffle once per stage. A day present on either
    side appears with zeros for the other.
    """
    clicks = city_traffic(silver_clicks, located_properties(tables)).select(
        "city",
        "event_date",
        "user_id",
        *[(F.col("event") == event).alias(name) for name, event in EVENT_COLUMNS.items()],
    )
    bookers = silver_bookings.where(in_booking_window("booking_date", boundaries)).select(
        "city",
        F.col("booking_date").alias("event_date"),
        "user_id",
        *[flag.alias(name) for name, flag in stage_flags(config.today()).items()],
    )
    names = [*EVENT_COLUMNS, *STAGES]
    return count_members(
        clicks.unionByName(bookers, allowMissingColumns=True),
        ["city", "event_date"],
        "user_id",
        {name: F.col(name) for name in names},
    )


def attributed_bookings(
    tables: MarketTables, silver_clicks: DataFrame, silver_bookings: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Each booking in the window with the device its user last touched before it.

    A booking has one row per payment in the silver table; the touch is the same for all
    of them, and of the payments the first status in alphabetical order is kept.
    """
    moments = silver_bookings.where(in_booking_window("booking_date", boundaries)).select(
        "booking_id",
        "user_id",
        "city",
        "booking_created_at",
        "booking_status",
        "payment_status",
        "check_out",
    )
    touched = last_touch(
        moments,
        silver_clicks.select("user_id", "timestamp", "device"),
        key="user_id",
        moment="booking_created_at",
        at="timestamp",
        value="device",
        hours=config.attribution_hours,
    )
    return top_per_key(
        touched,
        ["booking_id"],
        [F.col("timestamp").desc(), F.col("device"), F.col("payment_status").asc_nulls_last(), F.col("city")],
    )


def device_funnel(
    tables: MarketTables, silver_clicks: DataFrame, silver_bookings: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Per city, device and week: viewers, and bookers by last touched device."""
    viewers = (
        city_traffic(silver_clicks, located_properties(tables))
        .where(is_view() & F.col("device").isNotNull())
        .select(
            "city",
            "device",
            F.date_trunc("week", "event_date").alias("week_start"),
            "user_id",
            F.lit(True).alias("viewers"),
        )
    )
    bookers = attributed_bookings(tables, silver_clicks, silver_bookings, boundaries, config).select(
        "city",
        "device",
        F.date_trunc("week", F.to_date("booking_created_at")).alias("week_start"),
        "user_id",
        *[flag.alias(name) for name, flag in stage_flags(config.today()).items()],
    )
    counts = count_members(
        viewers.unionByName(bookers, allowMissingColumns=True),
        ["city", "device", "week_start"],
        "user_id",
        {name: F.col(name) for name in ("viewers", *STAGES)},
    )
    viewed = F.col("viewers")
    return counts.select(
        "*",
        safe_rate(F.col("initiated_bookers"), viewed).alias("initiation_rate"),
        safe_rate(F.col("confirmed_bookers"), viewed).alias("confirmation_rate"),
        safe_rate(F.col("completers"), viewed).alias("completion_rate"),
    )
