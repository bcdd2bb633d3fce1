"""The input tables of the marketplace and how to read them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# The columns the plans read, as DDL.
SCHEMAS = {
    "clickstream": "user_id BIGINT, property_id BIGINT, event STRING, timestamp TIMESTAMP, "
    "metadata STRUCT<device: STRING, referrer: STRING>",
    "bookings": "booking_id BIGINT, user_id BIGINT, property_id BIGINT, status STRING, "
    "total_amount DECIMAL(12,2), created_at TIMESTAMP, check_in DATE, check_out DATE",
    "payments": "payment_id BIGINT, booking_id BIGINT, status STRING, payment_method STRING, "
    "amount DECIMAL(12,2)",
    "properties": "property_id BIGINT, title STRING, property_type STRING, base_price DOUBLE, "
    "destination_id BIGINT, host_id BIGINT",
    "destinations": "destination_id BIGINT, destination STRING, country STRING",
    "hosts": "host_id BIGINT, name STRING, rating DOUBLE, is_verified BOOLEAN",
    "reviews": "property_id BIGINT, rating DOUBLE, is_deleted BOOLEAN",
    "amenities": "amenity_id BIGINT, name STRING, category STRING",
    "property_amenities": "property_id BIGINT, amenity_id BIGINT",
}


@dataclass(frozen=True)
class MarketTables:
    """One lazy DataFrame per input table."""

    clickstream: DataFrame
    bookings: DataFrame
    payments: DataFrame
    properties: DataFrame
    destinations: DataFrame
    hosts: DataFrame
    reviews: DataFrame
    amenities: DataFrame
    property_amenities: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str, **renamed: str) -> MarketTables:
        """Tables ``schema.<name>``; ``renamed`` gives other full names, for example
        ``clickstream="lab.default.clickstream_synthetic"``."""
        return cls(
            **{f.name: spark.table(renamed.get(f.name, f"{schema}.{f.name}")) for f in fields(cls)}
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> MarketTables:
        """Parquet folders ``root/<name>`` with the schemas above."""
        return cls(
            **{
                f.name: spark.read.schema(SCHEMAS[f.name]).parquet(f"{root.rstrip('/')}/{f.name}")
                for f in fields(cls)
            }
        )
