"""Registration of queries together with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innmetrics.checks.oracle_parts import with_parts
from innmetrics.config import Config
from innmetrics.plans.pipeline import Marketplace
from innmetrics.plans.synth import synthetic_clickstream
from innmetrics.session import work_folder
from innmetrics.sources import testdata


@dataclass(frozen=True)
class Inputs:
    """What a registered query reads."""

    spark: SparkSession
    sf_dir: str

    config = Config(as_of=testdata.AS_OF)

    def raw(self, table: str) -> DataFrame:
        return testdata.read(self.spark, self.sf_dir, table)

    @cached_property
    def market(self) -> Marketplace:
        return Marketplace(testdata.market_tables(self.spark, self.sf_dir), self.config)

    @property
    def tables(self):
        return self.market.tables

    @cached_property
    def synthetic(self) -> DataFrame:
        """Generated traffic, written once as the job that generates it does: the checks
        read it several times."""
        made = synthetic_clickstream(self.tables.bookings, self.config)
        path = self.folder("traffic")
        made.write.parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)

    def folder(self, purpose: str) -> str:
        return work_folder(self.spark, purpose)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(rows: DataFrame) -> DataFrame:
    """Types both engines share: bigint, double rounded to six places, local timestamps."""
    columns = []
    for f in rows.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            value = F.round(value.cast("double"), 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(f.name))
    return rows.select(*columns)


def check(name: str, sql: str | None = None, doubles: str = "", bigints: str = ""):
    """Registers a query; ``doubles`` and ``bigints`` name SQL columns to bring to the
    shared types."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: comparable(build(Inputs(spark, sf_dir)))
        if sql is not None:
            body = sql.strip()
            changes = [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in doubles.split()]
            changes += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints.split()]
            if changes:
                body = f"SELECT * REPLACE ({', '.join(changes)}) FROM (\n{body})"
            ORACLES[name] = with_parts(body)
        return build

    return register
