"""Counting events per key by time without pairing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.operators.slots import HOUR_MICROS, slot

_BEFORE = (Window.unboundedPreceding, -1)
_THROUGH = (Window.unboundedPreceding, Window.currentRow)


def _stacked(
    probes: DataFrame, events: DataFrame, keys: Sequence[str], bound: str, at: str, counts: Mapping[str, Column]
) -> DataFrame:
    """Probes (``_probe`` set) and events in one frame, both with their time as ``_at``."""
    present = " AND ".join(f"{column} IS NOT NULL" for column in [*keys, "_at"])
    steps = events.select(*keys, F.col(at).alias("_at"), *[c.cast("bigint").alias(f"_{n}") for n, c in counts.items()])
    payload = F.struct(*[c for c in probes.columns if c not in keys])
    none = [F.lit(0).cast("bigint").alias(f"_{name}") for name in counts]
    asks = probes.select(*keys, F.col(bound).alias("_at"), *none, payload.alias("_probe"))
    return asks.unionByName(steps, allowMissingColumns=True).where(present)


def count_before(
    probes: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    bound: str,
    at: str,
    counts: Mapping[str, Column] | None = None,
    slot_micros: int = HOUR_MICROS,
) -> DataFrame:
    """Adds to each probe how many events of the same keys have ``at`` < ``bound``
    (``events_before``), and how many there are at any time (``events_before_ever``).

    Both times are microseconds. The number of events between two times is the difference
    of two such counts, so a range join that only feeds counts never has to form its
    pairs. NULL keys and times match nothing, as in an equi-join: such probes count 0.

    A table of counts per key and time slot carries running sums over the slots; a probe
    takes the sum up to its slot, and only its own slot is counted row by row, in one
    running pass. A key that holds much of the table is spread by its slots, so light and
    heavy keys go the same way. ``counts`` may give several counters, as expressions over
    the events.
    """
    keys, counts = list(keys), counts or {"events_before": F.lit(1)}
    stacked = _stacked(probes, events, keys, bound, at, counts).withColumn("_slot", slot(F.col("_at"), slot_micros))
    lane = [*keys, "_slot"]
    order = Window.partitionBy(*lane).orderBy(F.col("_at"), F.col("_probe").isNull()).rowsBetween(*_THROUGH)
    within = (
        stacked.select(*lane, "_probe", *[F.sum(f"_{name}").over(order).alias(f"_{name}") for name in counts])
        .where("_probe IS NOT NULL")
    )
    sums = stacked.groupBy(*lane).agg(
        *[F.sum(f"_{name}").alias(f"_{name}") for name in counts], F.bool_or(F.col("_probe").isNotNull()).alias("_asked")
    )
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(*_BEFORE)
    whole = Window.partitionBy(*keys)
    running = sums.select(
        *lane,
        "_asked",
        *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_earlier_{name}") for name in counts],
        *[F.sum(f"_{name}").over(whole).alias(f"_all_{name}") for name in counts],
    ).where("_asked")
    found = within.join(running, lane).select(
        *keys,
        "_probe.*",
        *[(F.col(f"_{name}") + F.col(f"_earlier_{name}")).alias(name) for name in counts],
        *[F.col(f"_all_{name}").alias(f"{name}_ever") for name in counts],
    )
    unanswerable = probes.where(" OR ".join(f"{column} IS NULL" for column in [*keys, bound]))
    zeros = [F.lit(0).cast("bigint").alias(n) for n in (*counts, *[f"{name}_ever" for name in counts])]
    return found.unionByName(unanswerable.select("*", *zeros))


def count_within(
    probes: DataFrame, events: DataFrame, keys: Sequence[str], moment: str, at: str, reach: int, by: Sequence[str]
) -> DataFrame:
    """``by`` and ``events``: the events of the same keys in [moment - reach, moment], both
    ends included, summed over the probes with the same ``by``; all in microseconds.

    Time is cut into slots as long as the reach, so the events lie in the moment's slot
    and the one before. The moment asks in both: up to itself in its own, and from the
    window's start to the end in the other. Counts are running sums within a slot, no pair
    of moment and event is formed, and a key with many events is spread by its slots.
    """
    keys = list(keys)
    own, start = slot(F.col(moment), reach), F.col(moment) - reach
    parts = F.array(
        F.struct(own.alias("_slot"), (F.col(moment) + 1).alias("_at"), F.lit(True).alias("_from_start")),
        F.struct((own - 1).alias("_slot"), start.alias("_at"), F.lit(False).alias("_from_start")),
    )
    asks = probes.select(*dict.fromkeys([*by, *keys]), F.inline(parts)).withColumn("_n", F.lit(0))
    steps = events.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_n")).withColumn("_slot", slot(F.col("_at"), reach))
    present = " AND ".join(f"{column} IS NOT NULL" for column in [*keys, "_at"])
    stacked = asks.unionByName(steps, allowMissingColumns=True).where(present)
    lane = Window.partitionBy(*keys, "_slot")
    before = F.sum("_n").over(lane.orderBy(F.col("_at"), F.col("_from_start").isNull()).rowsBetween(*_THROUGH))
    counted = stacked.withColumn("_before", before).withColumn("_all", F.sum("_n").over(lane))
    count = F.when(F.col("_from_start"), F.col("_before")).otherwise(F.col("_all") - F.col("_before"))
    return counted.where("_from_start IS NOT NULL").groupBy(*by).agg(F.sum(count).alias("events"))
