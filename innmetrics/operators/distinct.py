"""Distinct counts under several conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_members(
    rows: DataFrame, group: Sequence[str], member: str, flags: Mapping[str, Column]
) -> DataFrame:
    """For each group and flag, the number of distinct members with the flag on any row.

    Equals one ``COUNT(DISTINCT CASE WHEN flag THEN member END)`` per flag. Rows shrink to
    one per (group, member) before and after the first shuffle, so a group holding much of
    the table is still spread by member, and no Expand multiplies rows by the flag count.
    """
    marked = rows.select(*group, member, *[flag.alias(name) for name, flag in flags.items()])
    members = marked.groupBy(*group, member).agg(*[F.bool_or(name).alias(name) for name in flags])
    return members.groupBy(*group).agg(
        *[F.count_if(F.col(name) & F.col(member).isNotNull()).alias(name) for name in flags]
    )


def count_distinct(
    rows: DataFrame,
    group: Sequence[str],
    members: Mapping[str, str],
    counts: Mapping[str, str],
    ends: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Distinct counts of several columns per group, with row counts and smallest or
    largest values, in one pass.

    Several COUNT(DISTINCT ...) in one aggregation would copy every row once per column.
    Here the rows of each member column are reduced to one per value within each task
    before they are stacked, so what grows with the table is read as it is and only
    values are shuffled.
    """
    ends = ends or {}
    parts = []
    for name, column in members.items():
        values = rows.where(F.col(column).isNotNull()).groupBy(*group, column).agg(F.lit(1).alias("_one"))
        parts.append(values.groupBy(*group).agg(F.count("*").alias(name)))
    totals = rows.groupBy(*group).agg(
        *[F.count(column).alias(name) for name, column in counts.items()],
        *[getattr(F, kind)(column).alias(name) for name, (kind, column) in ends.items()],
    )
    names = [*members, *counts, *ends]
    stacked = totals
    for part in parts:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    merged = [F.max(name).alias(name) for name in names]
    filled = [F.coalesce(name, F.lit(0).cast("bigint")).alias(name) if name in members else F.col(name) for name in names]
    return stacked.groupBy(*group).agg(*merged).select(*group, *filled)
