"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "innmetrics", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder that the cluster names in
    ``spark.checkpoint.dir``. Without that setting only a local session may go on, in
    a temporary folder: on a cluster other machines could not see it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="innmetrics-")
    return f"{shared.rstrip('/')}/innmetrics/{purpose}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists in whatever store ``path`` names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, in whatever store ``path`` names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def list_files(spark: SparkSession, path: str) -> set[str]:
    """Names of the files right below ``path``; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in store.listStatus(place)} if store.exists(place) else set()


def list_folders(spark: SparkSession, path: str, newest_first: bool = False) -> list[str]:
    """Complete folders right below ``path``, by name or by age: those that a Spark writer
    has committed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    found = [(s.getModificationTime(), s.getPath().toString()) for s in store.listStatus(place) if s.isDirectory()]
    done = [(at, f) for at, f in found if folder_exists(spark, f"{f}/_SUCCESS")]
    return [f for _, f in sorted(done, reverse=True)] if newest_first else sorted(f for _, f in done)
