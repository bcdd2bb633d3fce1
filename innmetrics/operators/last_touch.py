"""Last touch before a moment: an as-of join within a time limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.operators.slots import HOUR_MICROS, micros, slot

_THROUGH = (Window.unboundedPreceding, Window.currentRow)


def last_touch(
    moments: DataFrame, touches: DataFrame, key: str, moment: str, at: str, value: str, hours: int = 24
) -> DataFrame:
    """Moments with the latest touch of the same key in [moment - hours, moment].

    Adds ``value`` and ``at`` of that touch; moments without one are left out. Of touches
    at the same time the smallest ``value`` wins.

    Time is cut into slots as long as the window, so the touch lies in the moment's slot
    or is the closing one of the slot before. Within a slot the latest touch is carried
    forward over the stacked rows of a key; closing touches, one row per key and slot, are
    joined by slot. No pair of moment and touch is formed, and a key with many touches is
    spread by its slots.
    """
    length = hours * HOUR_MICROS
    lane = [key, "_slot"]
    steps = touches.where(F.col(key).isNotNull() & F.col(value).isNotNull() & F.col(at).isNotNull()).select(
        key, slot(micros(at), length).alias("_slot"), F.col(at).alias("_at"), F.col(value).alias("_value")
    )
    asks = moments.where(F.col(key).isNotNull() & F.col(moment).isNotNull()).select(
        key,
        slot(micros(moment), length).alias("_slot"),
        F.col(moment).alias("_at"),
        F.struct(*moments.columns).alias("_moment"),
    )
    stacked = steps.unionByName(asks, allowMissingColumns=True)
    order = Window.partitionBy(*lane).orderBy(F.col("_at"), F.col("_moment").isNotNull(), F.col("_value").desc())
    lately = order.rowsBetween(*_THROUGH)
    step_at = F.when(F.col("_moment").isNull(), F.col("_at"))
    here = stacked.select(
        *lane,
        "_at",
        "_moment",
        F.last("_value", ignorenulls=True).over(lately).alias("_touch_value"),
        F.last(step_at, ignorenulls=True).over(lately).alias("_touch_at"),
    ).where("_moment IS NOT NULL")
    latest = F.min(F.struct((-micros("_at")).alias("back"), "_value", "_at")).alias("_before")
    closing = steps.groupBy(*lane).agg(latest).select(key, (F.col("_slot") + 1).alias("_slot"), "_before")
    found = here.join(closing, lane, "left").select(
        "_at",
        "_moment",
        F.coalesce("_touch_value", F.col("_before._value")).alias("_touch_value"),
        F.coalesce("_touch_at", F.col("_before._at")).alias("_touch_at"),
    )
    return found.where(F.col("_touch_at") >= F.col("_at") - F.expr(f"INTERVAL {hours} HOURS")).select(
        "_moment.*", F.col("_touch_value").alias(value), F.col("_touch_at").alias(at)
    )
