"""Generated clickstream: browsing that leads to the given bookings, browsing before the
first booking, and users who only browse.

Every random choice is a draw on row ids, so the data is the same on every evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.draws import choose, draw, first_below, scaled, with_draws
from innmetrics.operators.dense_index import dense_index

HOUR, DAY = 3600, 86_400

# Fixed values: (earliest, latest) seconds before the booking and number of events.
EVENT_WINDOWS = (
    (7 * DAY, 28 * DAY, 3),
    (7 * DAY, 28 * DAY, 3),
    (7 * DAY, 21 * DAY, 2),
    (1 * DAY, 7 * DAY, 2),
    (1 * DAY, 7 * DAY, 2),
    (2 * DAY, 5 * DAY, 1),
    (60, 1 * HOUR, 1),
    (60, 1 * HOUR, 1),
    (10, 300, 1),
)

# Device and referrer shares of browse-only users.
DEVICE_SHARES = [("mobile", 0.50), ("desktop", 0.30), ("tablet", 0.20)]
REFERRER_SHARES = [("google", 0.40), ("direct", 0.25), ("ad", 0.20), ("email", 0.15)]

COLUMNS = ("user_id", "property_id", "event", "timestamp", "metadata")


def window_slots() -> Column:
    """The planned events of one booking as an array literal of structs."""
    return F.array(
        *[
            F.struct(
                F.lit(10 * place + number).cast("bigint").alias("event_seq"),
                F.lit(nearest).cast("bigint").alias("min_offset_seconds"),
                F.lit(farthest).cast("bigint").alias("max_offset_seconds"),
            )
            for place, (nearest, farthest, events) in enumerate(EVENT_WINDOWS)
            for number in range(events)
        ]
    )


def planned_events(bookings: DataFrame) -> DataFrame:
    """One row per booking and planned event; exploding a literal keeps this a narrow
    step where crossing with a table of windows would be a join."""
    return bookings.select("booking_id", "user_id", "property_id", "created_at", F.inline(window_slots()))


def events_per_window(bookings: DataFrame) -> DataFrame:
    """Planned events per window slot over all bookings."""
    return planned_events(bookings).groupBy("event_seq", "min_offset_seconds", "max_offset_seconds").agg(
        F.count("*").alias("planned_events")
    )


def chained_device(stream: int, *ids: str) -> Column:
    """Each step draws anew, so the shares are .50, .375 and .125."""
    return first_below([("mobile", stream, 0.50), ("desktop", stream + 1, 0.75)], "tablet", *ids)


def chained_referrer(stream: int, *ids: str) -> Column:
    """Each step draws anew, so the shares are .40, .39, .1785 and .0315."""
    steps = [("google", stream, 0.40), ("direct", stream + 1, 0.65), ("ad", stream + 2, 0.85)]
    return first_below(steps, "email", *ids)


def booking_events(bookings: DataFrame) -> DataFrame:
    """Views before each booking, at random offsets within the planned windows."""
    offset = F.col("min_offset_seconds") + scaled(0, "(max_offset_seconds - min_offset_seconds)")
    return with_draws(planned_events(bookings), range(6), "booking_id", "event_seq").select(
        "user_id",
        "property_id",
        F.lit("view").alias("event"),
        F.timestamp_seconds(F.unix_seconds("created_at") - offset).alias("timestamp"),
        F.struct(chained_device(1).alias("device"), chained_referrer(3).alias("referrer")).alias(
            "metadata"
        ),
    )


def booking_range(bookings: DataFrame) -> DataFrame:
    return bookings.agg(F.min("created_at").alias("first_booking"), F.max("created_at").alias("last_booking"))


def within_booking_range(events: DataFrame, bookings: DataFrame) -> DataFrame:
    """Events from the first booking on until ten seconds before the last one."""
    reach = booking_range(bookings).select(F.struct("first_booking", "last_booking")).scalar()
    return events.where(
        (F.col("timestamp") >= reach["first_booking"])
        & (F.col("timestamp") < reach["last_booking"] - F.expr("INTERVAL 10 SECONDS"))
    )


def sample_pairs(bookings: DataFrame, count: int) -> DataFrame:
    """A repeatable random sample of user/property pairs that booked."""
    pair = ("user_id", "property_id")
    order = [draw(6, *pair), draw(18, *pair), *pair]  # the second draw decides among equal first ones
    return bookings.select(*pair).distinct().orderBy(*order).limit(count)


def prelaunch_events(bookings: DataFrame, config: Config) -> DataFrame:
    """Views of sampled pairs in the week before the first booking. A pair keeps one
    device and referrer; each of its events has its own time."""
    pair = ("user_id", "property_id")
    first = F.unix_seconds(booking_range(bookings).select("first_booking").scalar())
    pairs = sample_pairs(bookings, config.prelaunch_pairs).select(
        *pair,
        F.struct(chained_device(7, *pair).alias("device"), chained_referrer(9, *pair).alias("referrer")).alias(
            "metadata"
        ),
    )
    numbered = pairs.withColumn("event_num", F.explode(F.sequence(F.lit(0), F.lit(config.prelaunch_events - 1))))
    return numbered.select(
        *pair,
        F.lit("view").alias("event"),
        F.timestamp_seconds(first - 7 * DAY + scaled(12, 7 * DAY, *pair, "event_num")).alias("timestamp"),
        "metadata",
    )


def browse_floor(bookings: DataFrame, config: Config) -> Column:
    """First id of browse-only users: beyond every booker's."""
    beyond = F.greatest(F.max("user_id") + 1, F.lit(config.browse_user_floor))
    return bookings.agg(F.coalesce(beyond, F.lit(config.browse_user_floor)).cast("bigint").alias("floor")).scalar()


def browse_only_users(bookings: DataFrame, config: Config) -> DataFrame:
    """user_id of as many new users as must browse without booking for the target
    conversion. Each booker brings its share of them, so their number need not be known
    before the plan runs."""
    bookers = dense_index(bookings.where("user_id IS NOT NULL"), "user_id", name="place")
    count = _different(bookings, "user_id").alias("bookers")
    floor = browse_floor(bookings, config)
    sized = bookers.select("place", count, floor.alias("floor")).withColumn(
        "browsers", F.floor(F.col("bookers") / F.lit(config.target_conversion)) - F.col("bookers")
    )
    share = "sequence(place * browsers div bookers, (place + 1) * browsers div bookers - 1)"
    own = "place * browsers div bookers < (place + 1) * browsers div bookers"
    numbered = sized.where(own).select("floor", F.explode(F.expr(share)).alias("number"))
    return numbered.select((F.col("floor") + F.col("number")).alias("user_id"))


def _different(rows: DataFrame, column: str) -> Column:
    """The number of different values as a scalar. Two COUNT(DISTINCT ...) would be merged
    into one aggregation that copies every row."""
    return rows.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count("*").alias("n")).scalar()


def browse_only_events(bookings: DataFrame, config: Config) -> DataFrame:
    """One to six views per browse-only user, on properties that have bookings."""
    properties = dense_index(bookings.where("property_id IS NOT NULL"), "property_id", name="place")
    choices = _different(bookings, "property_id").alias("choices")
    users = browse_only_users(bookings, config)
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), draw(13, "user_id") % 6))
    ids = ("user_id", "event_num")
    span = int((config.browse_end - config.browse_start).total_seconds())
    start = F.unix_seconds(F.lit(config.browse_start.isoformat(sep=" ") + " UTC").cast("timestamp"))
    drawn = with_draws(users.select("*", number.alias("event_num")).select("*", choices), range(14, 18), *ids)
    views = drawn.select(
        "user_id",
        scaled(14, "choices").alias("place"),
        F.timestamp_seconds(start + scaled(15, span)).alias("timestamp"),
        F.struct(choose(16, DEVICE_SHARES).alias("device"), choose(17, REFERRER_SHARES).alias("referrer")).alias(
            "metadata"
        ),
    )
    return views.join(properties, "place").select(
        "user_id", "property_id", F.lit("view").alias("event"), "timestamp", "metadata"
    )


def synthetic_clickstream(bookings: DataFrame, config: Config) -> DataFrame:
    """All generated events."""
    return (
        within_booking_range(booking_events(bookings), bookings)
        .unionByName(prelaunch_events(bookings, config))
        .unionByName(browse_only_events(bookings, config))
    )
