"""Marketplace tables derived from the star-schema test data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innmetrics.sources.tables import MarketTables

#: The test events span January 2024; this day leaves stays on both sides.
AS_OF = date(2024, 1, 20)

# The schemas of the files. Declared, reading needs no job to infer them.
RAW_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def clickstream(events: DataFrame) -> DataFrame:
    """Traffic from every event but purchases; works on batches and streams."""
    return events.where("event_type <> 'purchase'").selectExpr(
        "if(event_id % 50 = 0, NULL, user_id) AS user_id",
        "if(event_id % 41 = 0, NULL, cast(regexp_extract(props, '([0-9]+)', 1) AS bigint)) AS property_id",
        """CASE WHEN event_id % 37 = 0 THEN 'hover' WHEN event_type = 'signup' THEN 'search'
                WHEN event_type = 'error' THEN 'filter' ELSE event_type END AS event""",
        "cast(ts AS timestamp) AS timestamp",
        """named_struct(
             'device', CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 10 < 5 THEN 'mobile'
                            WHEN event_id % 10 < 8 THEN 'desktop' ELSE 'tablet' END,
             'referrer', CASE WHEN event_id % 20 < 8 THEN 'google' WHEN event_id % 20 < 13 THEN 'direct'
                              WHEN event_id % 20 < 17 THEN 'ad' ELSE 'email' END) AS metadata""",
    )


def bookings(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'purchase'").selectExpr(
        "event_id AS booking_id",
        "user_id",
        "cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS property_id",
        """CASE WHEN event_id % 10 = 0 THEN 'pending' WHEN event_id % 10 < 3 THEN 'cancelled'
                WHEN event_id % 10 < 6 THEN 'confirmed' ELSE 'completed' END AS status""",
        "cast(value AS decimal(12,2)) AS total_amount",
        "cast(ts AS timestamp) AS created_at",
        "date_add(cast(ts AS date), cast(event_id % 5 + 1 AS int)) AS check_in",
        "date_add(cast(ts AS date), cast(event_id % 5 + event_id % 4 + 2 AS int)) AS check_out",
    )


def payments(events: DataFrame) -> DataFrame:
    """One payment for most purchases, and a successful retry after each failed one."""
    paid = events.where("event_type = 'purchase' AND event_id % 7 <> 0")
    attempt = F.explode(
        F.when(F.expr("event_id % 11 = 0"), F.expr("array(0, 1)")).otherwise(F.expr("array(0)"))
    )
    return paid.select("event_id", "value", attempt.alias("retry")).selectExpr(
        "event_id * 10 + retry AS payment_id",
        "event_id AS booking_id",
        """CASE WHEN retry = 1 THEN 'completed' WHEN event_id % 11 = 0 THEN 'failed'
                WHEN event_id % 13 = 0 THEN 'pending' ELSE 'completed' END AS status""",
        "if(retry = 1 OR event_id % 3 = 0, 'card', 'wallet') AS payment_method",
        "cast(value AS decimal(12,2)) AS amount",
    )


def market_tables(spark: SparkSession, sf_dir: str) -> MarketTables:
    events = read(spark, sf_dir, "events")
    nation = read(spark, sf_dir, "nation")
    lineitem = read(spark, sf_dir, "lineitem")
    return MarketTables(
        clickstream=clickstream(events),
        bookings=bookings(events),
        payments=payments(events),
        properties=read(spark, sf_dir, "part").selectExpr(
            "p_partkey AS property_id",
            "p_name AS title",
            "p_type AS property_type",
            "p_retailprice AS base_price",
            "p_partkey % 5 AS destination_id",
            "p_partkey % 10 AS host_id",
        ),
        destinations=nation.join(
            read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).selectExpr(
            "cast(n_nationkey AS bigint) AS destination_id", "n_name AS destination", "r_name AS country"
        ),
        hosts=read(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS host_id",
            "s_name AS name",
            "cast(s_suppkey % 5 + 1 AS double) AS rating",
            "s_suppkey % 2 = 0 AS is_verified",
        ),
        reviews=lineitem.selectExpr(
            "l_partkey AS property_id",
            "cast(l_quantity % 5 + 1 AS double) AS rating",
            "l_returnflag = 'R' AS is_deleted",
        ),
        amenities=nation.selectExpr(
            "cast(n_nationkey AS bigint) AS amenity_id",
            "n_name AS name",
            "cast(n_regionkey AS string) AS category",
        ),
        property_amenities=lineitem.selectExpr(
            "l_partkey AS property_id", "l_suppkey % 25 AS amenity_id"
        ).distinct(),
    )
