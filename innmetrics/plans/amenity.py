"""Amenity lift and the best amenities per city and property type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.measures import safe_rate
from innmetrics.operators.quality import Constraint
from innmetrics.operators.ranking import top_per_key
from innmetrics.plans.performance import booking_facts, property_bookings, property_traffic
from innmetrics.plans.silver import listings, located_properties
from innmetrics.sources.tables import MarketTables

AMENITY_RULES = (Constraint("valid_amenity_data", "properties_with > 0 OR properties_without > 0"),)

_STAGES = {
    "initiation": "initiated_bookings",
    "confirmation": "confirmed_bookings",
    "completion": "completed_bookings",
}


def property_conversion(
    tables: MarketTables, pairs: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Booking rates per unique viewer, for properties with enough viewers. Bookings of a
    property without a known host do not count, as they are not in the booking table."""
    stats = property_bookings(booking_facts(tables, pairs, boundaries, config.today())).join(
        listings(tables).select("property_id"), "property_id", "left_semi"
    )
    rates = [
        safe_rate(F.col(count), F.col("unique_viewers"), above=config.min_viewers, otherwise=None)
        .cast("decimal(26,14)")  # leaves room for exact sums
        .alias(stage)
        for stage, count in _STAGES.items()
    ]
    return (
        located_properties(tables)
        .select("property_id", "city", "property_type")
        .join(property_traffic(pairs).where(F.col("unique_viewers") > config.min_viewers), "property_id")
        .join(stats, "property_id", "left")
        .select("property_id", "city", "property_type", *rates)
    )


def amenity_lift(
    tables: MarketTables, pairs: DataFrame, boundaries: DataFrame, config: Config
) -> DataFrame:
    """Mean booking rates of properties with and without each amenity.

    Crossing amenities with properties would grow with their product. Instead the bridge
    table gives the sums for properties that have the amenity, and "without" is the city
    and type total less those. Rates are decimals, so the subtraction is exact. Groups
    where no property or every property has the amenity are left out.
    """
    rates = property_conversion(tables, pairs, boundaries, config)
    bridge = tables.property_amenities.groupBy("property_id", "amenity_id").agg(
        F.count("*").cast("decimal(9,0)").alias("copies")
    )
    market = ["city", "property_type"]

    totals = rates.groupBy(F.col("city").alias("_city"), F.col("property_type").alias("_type")).agg(
        *[F.sum(stage).alias(f"{stage}_total") for stage in _STAGES], F.count("*").alias("properties")
    )
    having = (
        rates.join(bridge, "property_id")
        .groupBy("amenity_id", *market)
        .agg(
            *[F.sum(F.col(stage)).alias(f"{stage}_once") for stage in _STAGES],
            *[F.sum(F.col(stage) * F.col("copies")).alias(f"{stage}_with") for stage in _STAGES],
            F.sum("copies").alias("copies"),
            F.count("*").alias("properties_with"),
        )
    )
    same_market = F.col("city").eqNullSafe(F.col("_city")) & F.col("property_type").eqNullSafe(F.col("_type"))
    split = (
        having.join(totals, same_market)
        .withColumn("properties_without", F.col("properties") - F.col("properties_with"))
        .where("properties_without > 0")
    )

    def mean(total: Column, rows: Column) -> Column:
        return (total / rows).cast("decimal(38,14)")

    measures = []
    for stage in _STAGES:
        on = mean(F.col(f"{stage}_with"), F.col("copies"))
        off = mean(F.col(f"{stage}_total") - F.col(f"{stage}_once"), F.col("properties_without"))
        measures += [
            on.alias(f"avg_{stage}_with"),
            off.alias(f"avg_{stage}_without"),
            (on - off).alias(f"{stage}_lift"),
        ]
    named = tables.amenities.select(
        "amenity_id", F.col("name").alias("amenity_name"), F.col("category").alias("amenity_category")
    )
    lift = F.col("confirmation_lift")
    return (
        split.join(named, "amenity_id")
        .select(
            "amenity_id",
            "amenity_name",
            "amenity_category",
            *market,
            *measures,
            "properties_with",
            "properties_without",
        )
        .withColumn(
            "impact_tier",
            F.when(lift >= config.must_have_from, "must_have")
            .when(lift >= config.differentiator_from, "differentiator")
            .otherwise("low_impact"),
        )
    )


def amenity_city_top(lift: DataFrame, config: Config) -> DataFrame:
    """The amenities with the highest confirmation lift per city and property type; equal
    lifts are ordered by amenity id."""
    ranked = top_per_key(
        lift,
        ["city", "property_type"],
        [F.col("confirmation_lift").desc(), F.col("amenity_id")],
        count=config.top_amenities,
        rank="rank",
    )
    return ranked.select("city", "property_type", "amenity_name", "confirmation_lift", "rank")
