"""City funnel from day state: sets of users per city and day that can be merged.

Traffic grows by days, and its old days don't change. The state keeps each day's users as
bitmap words, one folder per day; a refresh reads the events of those days alone whose
files have changed. Bookings are updated in place and are far fewer, so their sets are
made anew each time. Funnels by day, week or month are counted from the sets without
going back to the events.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.operators.bitsets import WORD, count_bits, member_bits
from innmetrics.plans.funnels import EVENT_COLUMNS, STAGES, city_traffic, stage_flags
from innmetrics.plans.silver import date_boundaries, in_booking_window, located_properties
from innmetrics.session import folder_exists, remove_folder
from innmetrics.sources.parts import overwrite_parts
from innmetrics.sources.tables import MarketTables

NAMES = (*EVENT_COLUMNS, *STAGES)
_STATE = ", ".join(["city STRING", f"{WORD} BIGINT", *[f"{n} BIGINT" for n in EVENT_COLUMNS], "event_date DATE"])
_DAYS = "inputs STRING, event_date DATE"


def traffic_sets(silver_clicks: DataFrame, places: DataFrame) -> DataFrame:
    """Per city and day the users of each event type."""
    flags = {name: F.col("event") == event for name, event in EVENT_COLUMNS.items()}
    return member_bits(city_traffic(silver_clicks, places), ["city", "event_date"], "user_id", flags)


def booking_sets(silver_bookings: DataFrame, boundaries: DataFrame, config: Config) -> DataFrame:
    """Per city and day the users of each booking stage."""
    rows = silver_bookings.where(in_booking_window("booking_date", boundaries))
    rows = rows.withColumnRenamed("booking_date", "event_date")
    return member_bits(rows, ["city", "event_date"], "user_id", stage_flags(config.today()))


def funnel_of_sets(traffic: DataFrame, bookers: DataFrame, period: Column | None = None) -> DataFrame:
    """city, event_date (or ``period``, an expression over it) and all counts."""
    sets = traffic.unionByName(bookers, allowMissingColumns=True).fillna(0, list(NAMES))
    if period is not None:
        sets = sets.withColumn("event_date", period)
    return count_bits(sets, ["city", "event_date"], NAMES)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_STATE).parquet(f"{root}/traffic")


def read_days(spark: SparkSession, root: str) -> DataFrame:
    """inputs, event_date of every day that the state holds."""
    return spark.read.schema(_DAYS).parquet(f"{root}/days")


def update_state(silver_clicks: DataFrame, tables: MarketTables, root: str) -> list[date]:
    """Brings the day state below ``root`` up to date and returns the days it read again.

    ``silver_clicks`` is the stored event table, one folder per event_date, as ingest keeps
    it. A day is read again if its files are others than those the state was made from, and
    every day if a property has moved to another city. Days overwrite their own folder and
    are noted when all are done, so an update that fails is repeated.
    """
    spark = silver_clicks.sparkSession
    places = located_properties(tables).select("property_id", "city")
    located = places.agg(F.count("*"), F.sum(F.xxhash64("property_id", "city").cast("decimal(20,0)"))).first()
    now = _inputs_by_day(silver_clicks.inputFiles(), str(tuple(located)))
    known = {}
    if folder_exists(spark, f"{root}/days"):
        known = {r.event_date: r.inputs for r in read_days(spark, root).collect()}  # a row per day
    gone = sorted(set(known) - set(now))
    touched = sorted(day for day, inputs in now.items() if known.get(day) != inputs)
    if touched:
        rows = traffic_sets(silver_clicks.where(F.col("event_date").isin(touched)), places)
        overwrite_parts(rows, f"{root}/traffic", "event_date", touched)
    for day in gone:
        remove_folder(spark, f"{root}/traffic/event_date={day}")
    if touched or gone:
        noted = spark.createDataFrame([(now[day], day) for day in touched], _DAYS).coalesce(1)
        overwrite_parts(noted, f"{root}/days", "event_date", [*touched, *gone])
    return touched


def _inputs_by_day(files: list[str], places: str) -> dict[date, str]:
    """A digest of the names of each day's files, and of where properties are."""
    by_day: dict[date, list[str]] = defaultdict(list)
    for file in files:
        folder, name = file.rsplit("/", 2)[-2:]
        if folder.startswith("event_date=") and not folder.endswith("__"):
            by_day[date.fromisoformat(folder.removeprefix("event_date="))].append(name)
    return {day: hashlib.sha256("\n".join([places, *sorted(names)]).encode()).hexdigest() for day, names in by_day.items()}


def city_funnel_of_state(
    root: str, silver_bookings: DataFrame, config: Config, period: Column | None = None
) -> DataFrame:
    """The city funnel from day state and bookings; no events are read. ``period`` may name
    a wider one, as an expression over event_date, such as its week or month."""
    spark = silver_bookings.sparkSession
    bookers = booking_sets(silver_bookings, date_boundaries(read_days(spark, root)), config)
    return funnel_of_sets(read_state(spark, root), bookers, period)
