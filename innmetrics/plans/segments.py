"""City investment quadrants and device diagnosis, both over small funnel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.measures import DEVICES, HUNDRED, exact_mean, safe_rate


def city_totals(funnel: DataFrame) -> DataFrame:
    """Viewers here are daily distinct users summed: a user active on two days counts twice."""
    return (
        funnel.groupBy("city")
        .agg(F.sum("viewers").alias("total_viewers"), F.sum("completers").alias("total_completers"))
        .withColumn("conversion_rate", safe_rate(F.col("total_completers"), F.col("total_viewers")))
    )


def city_medians(totals: DataFrame) -> DataFrame:
    """Exact medians over one row per city."""
    return totals.agg(
        F.percentile("total_viewers", F.lit(0.5)).alias("median_viewers"),
        F.percentile("conversion_rate", F.lit(0.5)).alias("median_conversion"),
    )


def city_investment(funnel: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    totals = city_totals(funnel)
    # One subquery for both medians: taken apart, each would prune the funnel below it
    # differently and compute it again.
    medians = city_medians(totals).select(F.struct("median_viewers", "median_conversion")).scalar()
    booking_value = (
        silver_bookings.where("booking_status = 'confirmed'").agg(exact_mean(F.col("total_amount")).alias("value")).scalar()
    )
    busy = F.col("total_viewers") >= medians["median_viewers"]
    converting = F.col("conversion_rate") >= medians["median_conversion"]
    return totals.select(
        "city",
        "total_viewers",
        "total_completers",
        "conversion_rate",
        (F.col("total_completers") * booking_value).alias("estimated_revenue"),
        F.when(busy & ~converting, "Fix Supply/UX")
        .when(busy & converting, "Protect & Expand")
        .when(~busy & converting, "Invest Marketing")
        .otherwise("Deprioritize")
        .alias("quadrant"),
    )


def device_diagnosis(funnel: DataFrame, config: Config) -> DataFrame:
    """Per city: mean weekly confirmation rate per device, the desktop-to-mobile gap, and
    whether mobile rose between its first and last week.

    First and last week come from ordered aggregates, so the city's rows are read once.
    The ordering value is a struct because a NULL week must sort first, not be ignored.
    """
    week = F.struct("week_start")
    rate = F.col("confirmation_rate")
    per_device = funnel.groupBy("city", "device").agg(
        F.avg(rate).alias("mean_rate"),
        F.min_by(rate, week).alias("first_rate"),
        F.max_by(rate, week).alias("last_rate"),
    )
    mobile = F.col("device") == "mobile"
    cities = per_device.groupBy("city").agg(
        *[
            F.max(F.when(F.col("device") == device, F.col("mean_rate")).otherwise(0)).alias(f"{device}_rate")
            for device in DEVICES
        ],
        F.max(F.when(mobile, F.col("first_rate"))).alias("first_rate"),
        F.max(F.when(mobile, F.col("last_rate"))).alias("last_rate"),
    )
    desktop, phone = F.col("desktop_rate"), F.col("mobile_rate")
    gap = F.when(desktop > 0, (desktop - phone) * F.lit(HUNDRED) / desktop).otherwise(0)
    return cities.select(
        "city",
        *[f"{device}_rate" for device in DEVICES],
        gap.alias("device_gap_pct"),
        F.when(gap > config.ux_gap_above, "likely_ux_issue")
        .otherwise("likely_supply_pricing_issue")
        .alias("diagnosis"),
        F.when(F.col("last_rate") > F.col("first_rate"), "improving")
        .when(F.col("last_rate") < F.col("first_rate"), "declining")
        .otherwise("stable")
        .alias("mobile_trend"),
    )
