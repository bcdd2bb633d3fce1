"""What the operators share: reading tables, Arrow passes over texts, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innmetrics.session import work_folder

#: Rows that one step of an Arrow pass holds as Python objects.
STEP_ROWS = 1024

_ARROW = {
    "BIGINT": pa.int64(),
    "INT": pa.int32(),
    "DOUBLE": pa.float64(),
    "BOOLEAN": pa.bool_(),
    "STRING": pa.string(),
    "BINARY": pa.binary(),
    "ARRAY<INT>": pa.list_(pa.int32()),
    "ARRAY<BIGINT>": pa.list_(pa.int64()),
    "ARRAY<FLOAT>": pa.list_(pa.float32()),
    "ARRAY<DOUBLE>": pa.list_(pa.float64()),
    "ARRAY<STRING>": pa.list_(pa.string()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below the folder that ``spark.checkpoint.dir`` names and read
    back: lineage ends here, and a lost executor costs no earlier work."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Adds rank, from 0 in the given order, and total. Ranges of the order are numbered
    apart; only their sizes, one per shuffle partition, meet in one task."""
    dealt = written(rows.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part")), "ranges")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"),
        F.sum("_n").over(Window.partitionBy()).alias("total"),
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_place", place).join(shifts, "_part").select(
        *rows.columns, (F.col("_shift") + F.col("_place") - 1).alias("rank"), "total"
    )


def arrow_schema(ddl: str) -> pa.Schema:
    fields = [part.split() for part in ddl.split(", ")]
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])


def arrow_pass(
    rows: DataFrame,
    columns: Sequence[str],
    ddl: str,
    step: Callable[..., Sequence[Sequence]],
    step_rows: int = STEP_ROWS,
) -> DataFrame:
    """Applies ``step`` to lists of the named columns, some rows at a time.

    ``step`` returns the output columns in the order of ``ddl``; it may return any number
    of rows.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step_rows):
                part = batch.slice(start, step_rows)
                made = step(*[part.column(i).to_pylist() for i in range(part.num_columns)])
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(made, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.select(*columns).mapInArrow(run, ddl)


def bit_filter(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """One flag for each remainder of a bigint column by ``bits`` (a power of two), packed.

    The flags are made by Spark in blocks; their size doesn't depend on the rows. A filter
    has no misses, and more false hits the more rows there are, so what passes it must be
    looked at again.
    """
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    block = F.shiftright(place, 15).alias("block")
    blocks = rows.select(block, place.bitwiseAND(F.lit(32767)).alias("place")).groupBy("block")
    packed = np.zeros(bits // 8, np.uint8)
    for part in blocks.agg(F.expr("bitmap_construct_agg(place)").alias("flags")).toLocalIterator():
        packed[part.block * 4096 : (part.block + 1) * 4096] = np.frombuffer(part.flags, np.uint8)
    return packed


def passes(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit values hit a flag of ``bit_filter``."""
    low = values.view(np.uint64) & np.uint64(8 * len(packed) - 1)
    return (packed[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def plain_words(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def word_ids(words: Iterable[bytes]) -> np.ndarray:
    """Each word as the number of its first appearance among the different words."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
