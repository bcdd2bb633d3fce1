"""Refresh of all silver and gold tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.operators.quality import Constraint, enforce, observed
from innmetrics.plans import amenity, daily, funnels, performance, segments, silver
from innmetrics.session import folder_exists, remove_folder
from innmetrics.sources.tables import MarketTables


@dataclass(frozen=True)
class Marketplace:
    """All datasets as lazy DataFrames, each built from the ones before it."""

    tables: MarketTables
    config: Config = field(default_factory=Config)

    @cached_property
    def silver_clickstream(self) -> DataFrame:
        return silver.silver_clickstream(self.tables.clickstream)

    @cached_property
    def silver_bookings_enriched(self) -> DataFrame:
        return silver.silver_bookings(self.tables)

    @cached_property
    def date_boundaries(self) -> DataFrame:
        return silver.date_boundaries(self.silver_clickstream)

    @property
    def _silver(self) -> tuple[DataFrame, DataFrame]:
        return self.silver_clickstream, self.silver_bookings_enriched

    @cached_property
    def city_funnel(self) -> DataFrame:
        return funnels.city_funnel(self.tables, *self._silver, self.date_boundaries, self.config)

    @cached_property
    def city_investment(self) -> DataFrame:
        return segments.city_investment(self.city_funnel, self.silver_bookings_enriched)

    @cached_property
    def viewer_pairs(self) -> DataFrame:
        return performance.viewer_pairs(self.silver_clickstream)

    @cached_property
    def property_performance(self) -> DataFrame:
        return performance.property_performance(
            self.tables, self.viewer_pairs, self.date_boundaries, self.config
        )

    @cached_property
    def amenity_lift(self) -> DataFrame:
        return amenity.amenity_lift(self.tables, self.viewer_pairs, self.date_boundaries, self.config)

    @cached_property
    def amenity_city_top(self) -> DataFrame:
        return amenity.amenity_city_top(self.amenity_lift, self.config)

    @cached_property
    def device_funnel(self) -> DataFrame:
        return funnels.device_funnel(self.tables, *self._silver, self.date_boundaries, self.config)

    @cached_property
    def device_diagnosis(self) -> DataFrame:
        return segments.device_diagnosis(self.device_funnel, self.config)

    def create_views(self, prefix: str = "") -> None:
        """Temporary views of all datasets, for SQL."""
        for name in ("date_boundaries", *RULES):
            getattr(self, name).createOrReplaceTempView(prefix + name)


#: Tables in build order, with their rules. Those of silver tables are judged on the rows
#: before the rules, the others only warn.
RULES: dict[str, tuple[Constraint, ...]] = {
    "silver_clickstream": silver.CLICKSTREAM_RULES,
    "silver_bookings_enriched": silver.BOOKING_RULES,
    "city_funnel": funnels.FUNNEL_RULES,
    "city_investment": (),
    "property_performance": performance.PERFORMANCE_RULES,
    "amenity_lift": amenity.AMENITY_RULES,
    "amenity_city_top": (),
    "device_funnel": funnels.FUNNEL_RULES,
    "device_diagnosis": (),
}

#: Tables stored by date, so that the booking window and other date filters prune files.
PARTITIONED = {"silver_clickstream": "event_date"}


def refresh(
    market: Marketplace, root: str, streamed: DataFrame | None = None, days: str | None = None, keep: int | None = None
) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Writes every table of a new version below ``root`` and returns them with their
    violation counts.

    Each table is read back before the next one uses it: written tables cut the lineage,
    and a lost executor costs at most the table being written. Violations of all rules are
    counted in the writing pass itself. The version becomes the current one only when all
    its tables are done, so a failing constraint leaves the old tables as they were, and
    together. ``streamed`` is a cleaned event table kept by ingest; it is used as it is,
    and history isn't read again. With ``days``, a folder of day state that goes on from
    refresh to refresh, the city funnel reads only the events of days that gained files.
    ``keep`` removes all but so many of the newest versions.
    """
    spark = market.tables.bookings.sparkSession
    market = Marketplace(market.tables, market.config)
    version = uuid.uuid4().hex
    written: dict[str, DataFrame] = {}
    violations: dict[str, dict[str, int]] = {}
    for name, rules in RULES.items():
        if name == "property_performance":  # the one table that it and the amenities share
            pairs = f"{root}/{version}/_viewer_pairs"
            market.viewer_pairs.write.parquet(pairs)
            vars(market)["viewer_pairs"] = spark.read.schema(market.viewer_pairs.schema).parquet(pairs)
        if name == "silver_clickstream" and streamed is not None:
            written[name] = vars(market)[name] = streamed
            continue
        if name == "city_funnel" and streamed is not None and days:
            daily.update_state(streamed, market.tables, days)
            vars(market)[name] = daily.city_funnel_of_state(days, market.silver_bookings_enriched, market.config)
        if name in _BEFORE_RULES:
            rows, observation = observed(_BEFORE_RULES[name](market.tables), rules, name)
            rows = enforce(rows, rules)
        else:
            rows = getattr(market, name)
            if rules:
                rows, observation = observed(rows, rules, name)
        writer = rows.write
        if name in PARTITIONED:
            # Rebalancing gathers a date's rows in few files and splits a date that is too
            # big for one; otherwise every task would leave a file for every date.
            writer = rows.hint("rebalance", PARTITIONED[name]).write.partitionBy(PARTITIONED[name])
        path = f"{root}/{version}/{name}"
        writer.parquet(path)
        if rules:
            violations[name] = observation.get
        written[name] = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
        vars(market)[name] = written[name]  # later datasets build on the written one
    done = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    done.coalesce(1).write.mode("append").parquet(f"{root}/{VERSIONS}")
    if keep is not None:
        drop_versions(spark, root, keep)
    return written, violations


def drop_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Removes all complete versions but the ``keep`` newest, the current one included;
    readers of older ones must have ended. Versions that never were complete stay."""
    done = spark.read.parquet(f"{root}/{VERSIONS}").orderBy(F.desc("at"), "version").collect()  # a row per refresh
    for row in done[max(1, keep) :]:
        if folder_exists(spark, f"{root}/{row.version}"):
            remove_folder(spark, f"{root}/{row.version}")


_BEFORE_RULES = {
    "silver_clickstream": lambda tables: silver.flat_clickstream(tables.clickstream),
    "silver_bookings_enriched": silver.bookings_before_rules,
}

#: Folder of the versions that are complete; it only ever gains rows.
VERSIONS = "_versions"


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the latest complete version below ``root``, without a streamed one."""
    version = spark.read.parquet(f"{root}/{VERSIONS}").orderBy(F.desc("at"), "version").first().version
    names = [name for name in RULES if folder_exists(spark, f"{root}/{version}/{name}")]
    return {name: spark.read.parquet(f"{root}/{version}/{name}") for name in names}


def quality_report(spark: SparkSession, violations: dict[str, dict[str, int]]) -> DataFrame:
    """(dataset, constraint, action, passed, failed) of every rule, from the counts that
    the writing pass of ``refresh`` made."""
    lines = [
        (name, rule.name, rule.action, counts["row_count"] - counts[rule.name], counts[rule.name])
        for name, counts in violations.items()
        for rule in RULES[name]
    ]
    return spark.createDataFrame(
        lines, "dataset STRING, constraint STRING, action STRING, passed BIGINT, failed BIGINT"
    )
