"""Settings shared by all plans."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    """Parameters of a run. Defaults are the limits that the reports were defined with."""

    #: Day on which "past check-out" is judged; None means the day of the run.
    as_of: date | None = None
    #: Length of the last-touch window before a booking.
    attribution_hours: int = 24
    #: Amenity rates need more unique viewers than this.
    min_viewers: int = 5
    #: Confirmation-rate limits of the property categories, percent.
    intervention_below: int = 5
    promote_above: int = 10
    #: Payment-failure limit of the property categories, percent.
    payment_failure_above: int = 15
    #: Confirmation-lift limits of the amenity tiers, percentage points.
    must_have_from: int = 8
    differentiator_from: int = 4
    #: Amenities kept per city and property type.
    top_amenities: int = 3
    #: Desktop-to-mobile gap that points to a UX problem, percent.
    ux_gap_above: int = 25
    #: Ids from here on belong to generated browse-only users.
    browse_user_floor: int = 200_000
    #: Share of viewers that book in generated traffic.
    target_conversion: float = 0.44
    #: User/property pairs that browse in the week before the first booking.
    prelaunch_pairs: int = 50
    prelaunch_events: int = 10
    #: Period in which browse-only users are active.
    browse_start: datetime = datetime(2022, 12, 1)
    browse_end: datetime = datetime(2025, 7, 30)

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
