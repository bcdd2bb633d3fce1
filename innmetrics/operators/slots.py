"""Time slots by which rows of one key are spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000


def micros(moment: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone."""
    column = F.col(moment) if isinstance(moment, str) else moment
    return F.unix_micros(column.cast("timestamp"))


def slot(at: Column, length: int) -> Column:
    """Number of the slot of ``length`` microseconds; times before 1970 count downwards."""
    return F.call_function("div", at - F.pmod(at, F.lit(length)), F.lit(length))
