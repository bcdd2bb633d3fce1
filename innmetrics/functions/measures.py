"""Column expressions for funnel stages and rates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The domains the rules below refer to.
EVENT_TYPES = ("view", "click", "search", "filter")
VIEW_EVENTS = ("view", "click")
CONFIRMED_STATUSES = ("confirmed", "completed")
DEVICES = ("desktop", "mobile", "tablet")

HUNDRED = Decimal("100.0")


def safe_rate(part: Column, whole: Column, above: int = 0, otherwise: int | None = 0) -> Column:
    """``part`` per hundred ``whole``; ``otherwise`` unless ``whole`` exceeds ``above``.

    Counts give an exact decimal(38,14), so sums of rates do not depend on row order.
    """
    ratio = F.coalesce(part, F.lit(0)).cast("bigint") * F.lit(HUNDRED) / whole.cast("bigint")
    return F.when(F.coalesce(whole, F.lit(0)) > above, ratio).otherwise(
        F.lit(otherwise).cast("decimal(38,14)")
    )


def exact_mean(amount: Column) -> Column:
    """Mean of a decimal column: the sum is exact, so the result does not depend on row
    order, and it is not cut to the few places that avg of a decimal keeps."""
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def percent_share(part: Column, total: Column) -> Column:
    """Share of a total rounded to two places; NULL when the total is zero."""
    return F.round(F.try_divide(part * F.lit(HUNDRED), total), 2)


def is_view(event: str = "event") -> Column:
    return F.col(event).isin(*VIEW_EVENTS)


def is_confirmed(status: str = "booking_status") -> Column:
    return F.col(status).isin(*CONFIRMED_STATUSES)


def is_completed(today: Column) -> Column:
    """Stayed and paid: only bookings whose check-out lies before ``today`` count."""
    return (
        (F.col("booking_status") == "completed")
        & (F.col("payment_status") == "completed")
        & (F.col("check_out") < today)
    )
