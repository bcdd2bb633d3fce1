"""Row-quality constraints: drop the row, fail the run, or warn."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP, FAIL, WARN = "drop", "fail", "warn"


@dataclass(frozen=True)
class Constraint:
    """A named SQL predicate; a row passes only if it is TRUE, so NULL violates."""

    name: str
    predicate: str
    action: str = WARN

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def enforce(rows: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Drops violating rows and raises on violations of failing constraints.

    Both are plain filters: the check runs in the same pass as the job that writes the
    rows, and a violation fails that job before anything is committed.
    """
    for c in constraints:
        if c.action == FAIL:
            broken = F.raise_error(F.lit(f"constraint {c.name} violated")).cast("boolean")
            rows = rows.where(F.when(c.passes(), True).otherwise(broken))
    for c in constraints:
        if c.action == DROP:
            rows = rows.where(c.passes())
    return rows


def observed(rows: DataFrame, constraints: Sequence[Constraint], name: str) -> tuple[DataFrame, Observation]:
    """Rows that also count violations of every constraint while they are written."""
    observation = Observation(name)
    counts = [F.count_if(~c.passes()).alias(c.name) for c in constraints]
    return rows.observe(observation, F.count("*").alias("row_count"), *counts), observation


def report(rows: DataFrame, dataset: str, constraints: Sequence[Constraint]) -> DataFrame:
    """(dataset, constraint, action, passed, failed) for all constraints in one pass."""
    counts = rows.agg(
        *[F.count_if(c.passes()).alias(f"p{i}") for i, c in enumerate(constraints)],
        F.count("*").alias("total"),
    )
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(c.name).alias("constraint"),
            F.lit(c.action).alias("action"),
            F.col(f"p{i}").alias("passed"),
            (F.col("total") - F.col(f"p{i}")).alias("failed"),
        )
        for i, c in enumerate(constraints)
    ]
    return counts.select(F.inline(F.array(*lines)))
