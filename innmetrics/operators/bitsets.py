"""Sets of members as bitmaps, so that distinct counts can be merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of one bitmap word, by which the rows of a group are told apart.
WORD = "member_word"


def member_bits(rows: DataFrame, group: Sequence[str], member: str, flags: Mapping[str, Column]) -> DataFrame:
    """Per group and flag the set of members (integer ids) with the flag on any row, as
    bitmap words: one row per group and 64 neighbouring ids that occur, a bigint per flag.

    Words are merged by OR, in every task before the shuffle and whenever sets are put
    together, so sets of days give those of weeks. Dense ids take a bit each; scattered
    ones a row each, never more. Rows without a member are in no set; their group appears.
    """
    bit = F.expr(f"if({member} IS NULL, 0L, shiftleft(1L, cast({member} & 63 AS int)))")
    marked = rows.select(
        *group,
        F.shiftright(F.col(member), 6).alias(WORD),
        *[F.when(flag, bit).otherwise(F.lit(0).cast("bigint")).alias(name) for name, flag in flags.items()],
    )
    return merge_bits(marked, group, list(flags))


def merge_bits(sets: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The union of the sets of each group."""
    return sets.groupBy(*group, WORD).agg(*[F.bit_or(name).alias(name) for name in names])


def count_bits(sets: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The number of members of each set of a group; the groups may be wider than those the
    sets were made for. Equals a distinct count over the original rows."""
    merged = merge_bits(sets, group, names)
    return merged.groupBy(*group).agg(*[F.sum(F.bit_count(name)).cast("bigint").alias(name) for name in names])
