"""Repeatable pseudo-random draws.

A draw is a function of row ids, so a lost executor, a second action or another engine
gives the same rows. ``rand()`` would give a new stream on every evaluation of the plan.
Draws are built as SQL text: one expression is parsed where nested function calls would
each be a round trip to the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prime modulus, 2**31 - 1; products of two residues stay below the bigint limit.
MODULUS = 2_147_483_647


def _mixed_sql(stream: int, *ids: str) -> str:
    terms = [
        f"pmod({name} + {name} div {MODULUS}L * 611953, {MODULUS}L) * {7919 + 7907 * stream + 104_729 * place}"
        for place, name in enumerate(ids)
    ]
    return f"(({' + '.join(terms)} + {15_485_863 * (stream + 1)}) % {MODULUS}L)"


def draw_sql(stream: int, *ids: str) -> str:
    """Uniform integer in [0, MODULUS) from integer columns; ``stream`` keeps draws apart.
    Without ids it is the column that ``with_draws`` has made.

    Ids a modulus apart differ in their quotient, which is mixed in too. The fifth power
    permutes the residues of this prime, which breaks up the straight lines a plain linear
    mix would leave between two streams.
    """
    if not ids:
        return f"_draw{stream}"
    mixed = _mixed_sql(stream, *ids)
    square = f"({mixed} * {mixed} % {MODULUS}L)"
    return f"(({square} * {square} % {MODULUS}L) * {mixed} % {MODULUS}L)"


def with_draws(rows: DataFrame, streams: Sequence[int], *ids: str) -> DataFrame:
    """Adds the draws of several streams as columns, one step of the power after the other.

    They come out of a generator of one row, which filters can't be moved across: a filter
    on what is drawn would otherwise spell out all draws again, in a method that the JVM
    will not compile.
    """
    mixed = rows.select("*", *[F.expr(_mixed_sql(s, *ids)).alias(f"_mixed{s}") for s in streams])
    squared = mixed.select("*", *[F.expr(f"_mixed{s} * _mixed{s} % {MODULUS}L").alias(f"_square{s}") for s in streams])
    power = "(_square{0} * _square{0} % {1}L) * _mixed{0} % {1}L"
    drawn = F.struct(*[F.expr(power.format(s, MODULUS)).alias(f"_draw{s}") for s in streams])
    return squared.select(*rows.columns, F.inline(F.array(drawn)))


def draw(stream: int, *ids: str) -> Column:
    return F.expr(draw_sql(stream, *ids))


def scaled(stream: int, span: str | int, *ids: str) -> Column:
    """Uniform integer in [0, span); ``span`` is a number or an integer column. A span
    beyond MODULUS, which a draw could not fill, is an error."""
    if isinstance(span, int):
        if span > MODULUS:
            raise ValueError(f"span {span} of a draw is too large")
        return F.expr(f"{draw_sql(stream, *ids)} * {span}L div {MODULUS}L")
    fits = f"if({span} > {MODULUS}L, cast(raise_error('span of a draw is too large') AS bigint), {span})"
    return F.expr(f"{draw_sql(stream, *ids)} * {fits} div {MODULUS}L")


def first_below(steps: list[tuple[str, int, float]], otherwise: str, *ids: str) -> Column:
    """The value of the first step (value, stream, share) whose draw falls below its share."""
    cases = " ".join(
        f"WHEN {draw_sql(stream, *ids)} < {round(share * MODULUS)} THEN '{value}'" for value, stream, share in steps
    )
    return F.expr(f"CASE {cases} ELSE '{otherwise}' END")


def choose(stream: int, shares: list[tuple[str, float]], *ids: str) -> Column:
    """One of the named values with the given shares (adding up to 1)."""
    steps, reached = [], 0.0
    for value, share in shares[:-1]:
        reached += share
        steps.append((value, stream, reached))
    return first_below(steps, shares[-1][0], *ids)
