"""Jobs for spark-submit: generate traffic, ingest new events, refresh and publish the tables.

    python -m innmetrics generate --source lab.market --output /shared/clicks
    python -m innmetrics ingest --clicks '/shared/drops/*' --output /shared/silver
    python -m innmetrics refresh --source lab.market --output /shared/tables --streamed /shared/silver/events
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from innmetrics.config import Config
from innmetrics.plans.pipeline import Marketplace, quality_report, refresh
from innmetrics.plans.silver import silver_clickstream
from innmetrics.plans.synth import synthetic_clickstream
from innmetrics.sources.serving import sync_all
from innmetrics.sources.tables import SCHEMAS, MarketTables
from innmetrics.streaming.ingest import file_stream, ingest_clickstream
from innmetrics.streaming.rules import logged_violations


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="innmetrics")
    parser.add_argument("job", choices=["generate", "ingest", "refresh"])
    parser.add_argument("--source", help="catalog schema, or with --parquet a folder, of the inputs")
    parser.add_argument("--parquet", action="store_true", help="the inputs are parquet folders")
    parser.add_argument("--clickstream", help="full name of another clickstream table")
    parser.add_argument("--clicks", help="ingest: folder or glob of raw clickstream files, which only gains files")
    parser.add_argument("--streamed", help="refresh: event table that ingest keeps, used instead of raw events")
    parser.add_argument("--keep", type=int, help="refresh: versions to keep, the new one included")
    parser.add_argument("--output", required=True, help="folder for the results")
    parser.add_argument("--publish", help="catalog schema for the serving tables")
    parser.add_argument("--as-of", type=date.fromisoformat, help="day on which stays count as past")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("innmetrics").getOrCreate()
    if options.job == "ingest":
        source = file_stream(spark, options.clicks, SCHEMAS["clickstream"])
        ingest_clickstream(source, f"{options.output}/events", f"{options.output}/checkpoint", f"{options.output}/rules")
        print(logged_violations(spark, f"{options.output}/rules"))
        return
    renamed = {"clickstream": options.clickstream} if options.clickstream else {}
    if options.parquet:
        tables = MarketTables.from_parquet(spark, options.source)
    else:
        tables = MarketTables.from_catalog(spark, options.source, **renamed)
    config = Config(as_of=options.as_of)

    if options.job == "generate":
        synthetic_clickstream(tables.bookings, config).write.mode("overwrite").parquet(options.output)
        return
    streamed = None
    if options.streamed:
        columns = silver_clickstream(tables.clickstream).schema
        streamed = spark.read.schema(columns).parquet(options.streamed).select(*columns.names)
    written, violations = refresh(Marketplace(tables, config), options.output, streamed, f"{options.output}/_days", options.keep)
    if options.streamed:  # the rules of events were counted by ingest
        violations |= logged_violations(spark, f"{options.streamed.rsplit('/', 1)[0]}/rules")
    quality_report(spark, violations).show(100, truncate=False)
    if options.publish:
        sync_all(spark, written, options.publish, f"{options.output}/serving").show(truncate=False)


if __name__ == "__main__":
    main()
