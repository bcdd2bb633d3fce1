"""Serving tables: snapshots with a primary key, and changes on top of them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innmetrics.operators.ranking import duplicate_keys, top_per_key
from innmetrics.session import list_folders, remove_folder, work_folder
from innmetrics.sources.parts import overwrite_parts


class DuplicateKeyError(ValueError):
    """A primary key occurs more than once."""


@dataclass(frozen=True)
class SyncTarget:
    source: str
    table: str
    keys: tuple[str, ...]
    description: str
    #: "snapshot" replaces the table; "merge" folds rows in by ``latest``.
    mode: str = "snapshot"
    latest: tuple[str, ...] = ()
    #: Parts that the stored rows of a merged table are dealt into by key.
    buckets: int = 1


# The published tables and their primary keys. The top amenities are keyed
# by rank, since one amenity may lead for several property types of a city.
SYNC_TARGETS = (
    SyncTarget("city_funnel", "city_funnel", ("city", "event_date"), "Daily funnel per city"),
    SyncTarget("amenity_city_top", "amenity_city_top", ("city", "property_type", "rank"), "Top amenities"),
    SyncTarget("amenity_lift", "amenity_lift", ("amenity_id", "city", "property_type"), "Amenity lift"),
    SyncTarget("device_funnel", "device_funnel", ("city", "device", "week_start"), "Weekly funnel per device"),
    SyncTarget("city_investment", "city_investment", ("city",), "Investment quadrants"),
    SyncTarget("property_performance", "property_performance", ("property_id",), "Property performance"),
    SyncTarget("device_diagnosis", "device_diagnosis", ("city",), "Device gap and mobile trend"),
)


#: Column of the stored rows that names the bucket of their key, and the mark of deleted keys.
BUCKET, DELETED = "_bucket", "_deleted"


@dataclass(frozen=True)
class ServingTable:
    """A published view over parquet folders below ``root``.

    A snapshot goes to a new folder, and the view moves to it in one step, also where the
    columns change, so readers see whole versions. Rows are stored by ``buckets`` of their
    key. Changes read and overwrite the buckets they touch with Spark's dynamic partition
    overwrite; the files of all others stay. A query that reads a touched bucket at that
    moment may have to be repeated, and a merge that fails is repeated as a whole, which
    gives the same table. Deleted keys leave a mark, so that an older change that comes
    late can't bring them back.
    """

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    root: str
    buckets: int = 1
    #: Older versions that a snapshot leaves in place.
    keep: int = 1

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def location(self) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name}('path')").first().value

    def stored(self) -> DataFrame:
        """The rows as stored, with ``_deleted`` marks and buckets."""
        return self.spark.read.parquet(self.location())

    def snapshot(self, rows: DataFrame) -> None:
        """Replaces the table. The written version is checked for unique keys before
        readers can see it, so the source plan runs once."""
        path = f"{self.root}/{self.name}/{uuid.uuid4().hex}"
        placed = self._placed(rows)
        if self.buckets > 1:
            placed = placed.hint("rebalance", BUCKET)  # few files per bucket, several for a large one
        placed.write.partitionBy(BUCKET).parquet(path)
        # a file without rows: the columns are known also where no bucket has any
        placed.limit(0).drop(BUCKET).write.parquet(f"{path}/{BUCKET}=-1")
        written = self.spark.read.schema(placed.schema).parquet(path)
        self._check_keys(written, lambda: remove_folder(self.spark, path))
        columns = ", ".join(f"`{c}`" for c in rows.columns if c != DELETED)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('path' = '{path}') "
            f"AS SELECT {columns} FROM parquet.`{path}` WHERE NOT {DELETED}"
        )
        self._drop_old_versions()

    def merge(self, changes: DataFrame, latest: Sequence[str]) -> None:
        """Folds changed rows in: per key the row with the highest ``latest`` stays, and
        among equals the change. Where changes have a column ``_deleted``, a key whose
        latest row has it set is gone; only its key and ``latest`` columns matter then.
        The first merge starts the table."""
        if not self.exists():
            self.snapshot(newest(self._placed(changes.limit(0)), changes, self.keys, latest).drop(BUCKET))
            return
        staged, touched = self._staged(changes)
        base = self.stored().where(F.col(BUCKET).isin(touched))
        self._replace(newest(base, staged, self.keys, latest), touched)

    def insert(self, rows: DataFrame) -> None:
        """Adds rows; a key that is there already is an error and changes nothing."""
        staged, touched = self._staged(rows)
        base = self.stored().where(F.col(BUCKET).isin(touched))
        there = base.where(f"NOT {DELETED}").select(*self.keys).unionByName(staged.select(*self.keys))
        self._check_keys(there)
        gone = base.where(DELETED).join(staged.select(*self.keys), list(self.keys), "left_anti")
        self._replace(insert_rows(base.where(f"NOT {DELETED}").unionByName(gone), staged), touched)

    def update(self, where: Column, changed: Mapping[str, Column]) -> None:
        if set(changed) & set(self.keys):
            raise ValueError(f"{self.name}: key columns can't be updated")
        hit = F.coalesce(where, F.lit(False)) & ~F.col(DELETED)
        touched = self._touched(self.stored().where(hit))
        self._replace(update_rows(self.stored().where(F.col(BUCKET).isin(touched)), hit, changed), touched)

    def delete(self, where: Column) -> None:
        """Removes rows, and leaves no mark of them."""
        hit = F.coalesce(where, F.lit(False)) & ~F.col(DELETED)
        touched = self._touched(self.stored().where(hit))
        self._replace(delete_rows(self.stored().where(F.col(BUCKET).isin(touched)), hit), touched)

    def forget_deleted(self, where: Column) -> None:
        """Removes marks of deleted keys, once no older change of them can come any more."""
        hit = F.col(DELETED) & F.coalesce(where, F.lit(False))
        touched = self._touched(self.stored().where(hit))
        self._replace(delete_rows(self.stored().where(F.col(BUCKET).isin(touched)), hit), touched)

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return _marked(rows).withColumn(BUCKET, bucket)

    def _staged(self, changes: DataFrame) -> tuple[DataFrame, list[int]]:
        """The changes, written once with their buckets, and which buckets they touch."""
        path = work_folder(self.spark, "changes")
        placed = self._placed(changes)
        placed.write.parquet(path)
        staged = self.spark.read.schema(placed.schema).parquet(path)
        return staged, self._touched(staged)

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most ``buckets`` rows

    def _replace(self, rows: DataFrame, touched: list[int]) -> None:
        if touched:
            overwrite_parts(rows, self.location(), BUCKET, touched)

    def _check_keys(self, rows: DataFrame, on_failure: Callable[[], None] = lambda: None) -> None:
        repeated = duplicate_keys(rows, self.keys).limit(1).collect()
        if repeated:
            on_failure()
            raise DuplicateKeyError(f"{self.name}: key {self.keys} repeats, for example {repeated[0]}")

    def _drop_old_versions(self) -> None:
        """Keeps the current version, the newest ``keep`` before it, and any that another
        view of the schema still shows."""
        used = {self.location().rsplit("/", 1)[-1]}
        schema = self.name.rpartition(".")[0]
        for other in self.spark.sql(f"SHOW VIEWS IN {schema}").collect() if schema else ():
            if not other.isTemporary:
                found = self.spark.sql(f"SHOW TBLPROPERTIES {schema}.{other.viewName}").collect()
                used |= {r.value.rsplit("/", 1)[-1] for r in found if r.key == "path"}
        versions = list_folders(self.spark, f"{self.root}/{self.name}", newest_first=True)
        for version in [v for v in versions if v.rsplit("/", 1)[-1] not in used][self.keep :]:
            remove_folder(self.spark, version)


def _marked(rows: DataFrame) -> DataFrame:
    mark = F.coalesce(DELETED, F.lit(False)) if DELETED in rows.columns else F.lit(False)
    return rows.withColumn(DELETED, mark)


def newest(base: DataFrame, changes: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """Per key the row with the highest ``latest`` columns of both inputs. Among equals a
    change wins over the base, and a deletion over another change."""
    changes = _marked(changes)
    stacked = base.withColumn("_change", F.lit(0)).unionByName(changes.withColumn("_change", F.lit(1)), True)
    order: list[Column] = [F.col(c).desc() for c in latest]
    return top_per_key(stacked, keys, [*order, F.col("_change").desc(), F.col(DELETED).desc()]).drop("_change")


def create_schema(spark: SparkSession, schema: str, root: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")


def sync_all(
    spark: SparkSession,
    datasets: Mapping[str, DataFrame],
    schema: str,
    root: str,
    targets: Sequence[SyncTarget] = SYNC_TARGETS,
    replace: bool = True,
    connections: int = 4,
) -> DataFrame:
    """Publishes every target, ``connections`` at a time, and returns (table, status,
    row_count, message).

    A failing table does not stop the rest. With ``replace=False`` existing tables are
    skipped.
    """
    create_schema(spark, schema, root)

    def publish(target: SyncTarget) -> tuple[str, str, str | None]:
        table = ServingTable(spark, f"{schema}.{target.table}", target.keys, root, target.buckets)
        if table.exists() and not replace:
            return target.table, "skipped", None
        try:
            if target.mode == "merge":
                table.merge(datasets[target.source], target.latest)
            else:
                table.snapshot(datasets[target.source])
            return target.table, "success", None
        except Exception as problem:  # one line per failed table in the summary
            return target.table, "error", str(problem).splitlines()[0]

    with ThreadPoolExecutor(connections) as pool:
        results = list(pool.map(publish, targets))
    counts = None
    for name, status, message in results:
        line = (
            ServingTable(spark, f"{schema}.{name}", (), root).read().agg(F.count("*").alias("row_count"))
            if status != "error"
            else spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        ).select(
            F.lit(name).alias("table"),
            F.lit(status).alias("status"),
            "row_count",
            F.lit(message).cast("string").alias("message"),
        )
        counts = line if counts is None else counts.unionByName(line)
    return counts


def publish_jdbc(
    rows: DataFrame, url: str, table: str, keys: Sequence[str], connections: int = 16, **options: str
) -> None:
    """Replaces a database table. The rows are written to the shared folder first, so
    their plan runs once and in full width; keys are checked there, because the database
    would only notice a repeated key halfway. ``connections`` tasks write at a time."""
    path = work_folder(rows.sparkSession, "publish")
    rows.write.parquet(path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    repeated = duplicate_keys(written, keys).limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"{table}: key {tuple(keys)} repeats, for example {repeated[0]}")
    writer = written.coalesce(connections).write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=table, truncate="true", **options).save()


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows)


def update_rows(table: DataFrame, where: Column, changed: Mapping[str, Column]) -> DataFrame:
    """The table with ``changed`` columns in matching rows; a NULL condition does not match."""
    hit = F.coalesce(where, F.lit(False))
    return table.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in changed.items()})


def delete_rows(table: DataFrame, where: Column) -> DataFrame:
    return table.where(~F.coalesce(where, F.lit(False)))
