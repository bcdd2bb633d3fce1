"""Property performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.measures import is_confirmed, is_view, safe_rate
from innmetrics.operators.quality import Constraint
from innmetrics.plans.silver import in_booking_window, listings
from innmetrics.sources.tables import MarketTables

PERFORMANCE_RULES = (
    Constraint("valid_initiation_rate", "initiation_rate BETWEEN 0 AND 100"),
    Constraint("valid_confirmation_rate", "confirmation_rate BETWEEN 0 AND 100"),
    Constraint("valid_completion_rate", "completion_rate BETWEEN 0 AND 100"),
    Constraint(
        "logical_funnel",
        "initiated_bookings >= confirmed_bookings AND confirmed_bookings >= completed_bookings",
    ),
)


def viewer_pairs(silver_clicks: DataFrame) -> DataFrame:
    """Views and clicks per user and property: one row each, so joining bookings to it
    never multiplies rows however often a user came back."""
    return (
        silver_clicks.where(is_view() & F.col("property_id").isNotNull())
        .groupBy("user_id", "property_id")
        .agg(F.count("*").alias("touches"))
    )


def property_traffic(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("property_id").agg(
        F.sum("touches").alias("views"), F.count("user_id").alias("unique_viewers")
    )


def payment_facts(payments: DataFrame) -> DataFrame:
    """One row per booking: payment rows, distinct and failed payments, and whether any
    payment completed. A payment id belongs to one booking."""
    status = F.col("status")
    once = payments.groupBy("booking_id", "payment_id").agg(
        F.count("*").alias("rows"),
        F.bool_or(status == "failed").alias("failed"),
        F.bool_or(status == "completed").alias("completed"),
    )
    known = F.col("payment_id").isNotNull()
    return once.groupBy("booking_id").agg(
        F.sum("rows").alias("payment_rows"),
        F.count_if(known).alias("total_payments"),
        F.count_if(known & F.col("failed")).alias("failed_payments"),
        F.bool_or("completed").alias("paid"),
    )


def booking_facts(tables: MarketTables, pairs: DataFrame, boundaries: DataFrame, today: Column) -> DataFrame:
    """One row per property and booking in the window whose user viewed or clicked that
    property at any time.

    ``revenue`` is the confirmed amount once per payment row and per touch of the user:
    the sum that joining bookings, payments and events row by row would give.
    ``amount`` is the confirmed amount once.
    """
    status = F.col("status")
    confirmed = F.when(status == "confirmed", F.col("total_amount"))
    weight = F.col("touches") * F.greatest(F.coalesce("payment_rows", F.lit(1)), F.lit(1))
    return (
        tables.bookings.where(in_booking_window(F.to_date("created_at"), boundaries))
        .select("booking_id", "user_id", "property_id", "status", "total_amount", "check_out")
        .join(pairs, ["user_id", "property_id"])
        .join(payment_facts(tables.payments), "booking_id", "left")
        .groupBy("property_id", "booking_id")
        .agg(
            F.bool_or(is_confirmed("status")).alias("confirmed"),
            F.bool_or((status == "completed") & F.col("paid") & (F.col("check_out") < today)).alias("completed"),
            F.bool_or(status == "cancelled").alias("cancelled"),
            F.sum(F.coalesce(confirmed * weight, F.lit(0))).cast("decimal(38,2)").alias("revenue"),
            F.max(confirmed).alias("amount"),
            F.max("total_payments").alias("total_payments"),
            F.max("failed_payments").alias("failed_payments"),
        )
    )


def property_bookings(facts: DataFrame) -> DataFrame:
    """Distinct bookings per stage, payments and revenue per property."""
    known = F.col("booking_id").isNotNull()
    return facts.groupBy("property_id").agg(
        F.count_if(known).alias("initiated_bookings"),
        F.count_if(known & F.col("confirmed")).alias("confirmed_bookings"),
        F.count_if(known & F.col("completed")).alias("completed_bookings"),
        F.count_if(known & F.col("cancelled")).alias("cancelled_bookings"),
        F.sum("total_payments").alias("total_payments"),
        F.sum("failed_payments").alias("failed_payments"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
    )


def property_revenue_clean(facts: DataFrame) -> DataFrame:
    """Confirmed revenue per property with every booking counted once."""
    return (
        facts.where("amount IS NOT NULL")
        .groupBy("property_id")
        .agg(F.sum("amount").cast("decimal(38,2)").alias("revenue"), F.count("booking_id").alias("bookings"))
    )


def review_stats(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("is_deleted") == F.lit(False))
        .groupBy("property_id")
        .agg(F.avg("rating").alias("avg_review_rating"), F.count("*").alias("review_count"))
    )


def property_performance(
    tables: MarketTables, pairs: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Traffic, booking stages, payments, revenue and reviews per property with traffic.

    Every fact is reduced to one row per property before it meets the others. ``pairs`` are
    those of ``viewer_pairs``: the clickstream is shuffled once, for traffic and bookings.
    """
    facts = booking_facts(tables, pairs, boundaries, config.today())

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    views = F.col("views")
    confirmation = safe_rate(F.col("confirmed_bookings"), views)
    failure = safe_rate(F.col("failed_payments"), F.col("total_payments"))
    category = (
        F.when(
            (confirmation < config.intervention_below) | (failure > config.payment_failure_above),
            "intervention",
        )
        .when(confirmation.between(config.intervention_below, config.promote_above), "at_risk")
        .when(confirmation >= config.promote_above, "promote")
        .otherwise("unknown")
    )
    return (
        listings(tables)
        .join(property_traffic(pairs), "property_id")
        .join(property_bookings(facts), "property_id", "left")
        .join(review_stats(tables.reviews), "property_id", "left")
        .select(
            "property_id",
            F.col("property_title").alias("property_name"),
            "property_type",
            "base_price",
            "city",
            "host_name",
            "host_rating",
            "host_verified",
            "views",
            "unique_viewers",
            *[
                count(name).alias(name)
                for name in ("initiated_bookings", "confirmed_bookings", "completed_bookings", "cancelled_bookings")
            ],
            safe_rate(F.col("initiated_bookings"), views).alias("initiation_rate"),
            confirmation.alias("confirmation_rate"),
            safe_rate(F.col("completed_bookings"), views).alias("completion_rate"),
            safe_rate(F.col("cancelled_bookings"), F.col("initiated_bookings")).alias("cancel_rate"),
            count("failed_payments").alias("failed_payments"),
            failure.alias("payment_fail_rate"),
            count("total_revenue").alias("total_revenue"),
            count("avg_review_rating").alias("avg_review_rating"),
            count("review_count").alias("review_count"),
            category.alias("performance_category"),
        )
    )
