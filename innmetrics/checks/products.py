"""Datasets, exploration, generated traffic and its validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from innmetrics.checks.oracle_parts import COMPLETED, CONFIRMED
from innmetrics.checks.registry import Inputs, check
from innmetrics.operators.quality import report
from innmetrics.plans import daily, explore, performance, silver, synth, validate
from innmetrics.plans.funnels import EVENT_COLUMNS, FUNNEL_RULES
from innmetrics.plans.pipeline import quality_report, refresh

# ------------------------------------------------------------------------ silver, gold


@check("silver_clickstream", "SELECT * FROM silver_clicks")
def silver_clickstream(i: Inputs):
    return i.market.silver_clickstream


@check(
    "silver_bookings_enriched",
    "SELECT * FROM silver_bookings",
    doubles="total_amount payment_amount base_price host_rating",
)
def silver_bookings_enriched(i: Inputs):
    return i.market.silver_bookings_enriched


@check("date_boundaries", "SELECT * FROM bounds")
def date_boundaries(i: Inputs):
    return i.market.date_boundaries


@check("city_funnel", "SELECT * FROM city_funnel")
def city_funnel(i: Inputs):
    return i.market.city_funnel


def _stored_clicks(i: Inputs, path: str, part) -> None:
    part.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(path)


def _day_state(i: Inputs) -> str:
    """Day state that followed the event table in two steps."""
    root = i.folder("days")
    clicks = i.market.silver_clickstream
    for later in (False, True):
        _stored_clicks(i, f"{root}/clicks", clicks.where((F.col("event_date") >= "2024-01-15") == later))
        stored = i.spark.read.schema(clicks.schema).parquet(f"{root}/clicks").select(*clicks.columns)
        daily.update_state(stored, i.tables, f"{root}/state")
    return f"{root}/state"


@check("incremental_city_funnel", "SELECT * FROM city_funnel")
def incremental_city_funnel(i: Inputs):
    return daily.city_funnel_of_state(_day_state(i), i.market.silver_bookings_enriched, i.config)


@check(
    "city_funnel_weekly",
    f"""SELECT city, event_date AS week_start, {", ".join(f"coalesce({n}, 0) AS {n}" for n in daily.NAMES)}
        FROM (
          SELECT city, CAST(date_trunc('week', event_date) AS DATE) AS event_date,
                 {", ".join(f"count(DISTINCT user_id) FILTER (WHERE event = '{e}') AS {n}" for n, e in EVENT_COLUMNS.items())}
          FROM silver_clicks JOIN located USING (property_id) GROUP BY 1, 2) AS clicks
        FULL JOIN (
          SELECT city, CAST(date_trunc('week', booking_date) AS DATE) AS event_date,
                 count(DISTINCT user_id) AS initiated_bookers,
                 count(DISTINCT user_id) FILTER (WHERE {CONFIRMED}) AS confirmed_bookers,
                 count(DISTINCT user_id) FILTER (WHERE {COMPLETED}) AS completers
          FROM window_bookings GROUP BY 1, 2) AS bookers USING (city, event_date)""",
)
def city_funnel_weekly(i: Inputs):
    """Different users per week from the days' sets: nobody counts twice."""
    week = F.date_trunc("week", "event_date").cast("date")
    weekly = daily.city_funnel_of_state(_day_state(i), i.market.silver_bookings_enriched, i.config, week)
    return weekly.withColumnRenamed("event_date", "week_start")


@check("city_investment", "SELECT * FROM city_investment", doubles="conversion_rate estimated_revenue")
def city_investment(i: Inputs):
    return i.market.city_investment


@check(
    "property_performance",
    "SELECT * FROM property_performance",
    doubles="base_price host_rating initiation_rate confirmation_rate completion_rate cancel_rate "
    "payment_fail_rate total_revenue avg_review_rating",
)
def property_performance(i: Inputs):
    return i.market.property_performance


@check(
    "property_revenue_clean",
    """SELECT property_id, sum(amount) AS revenue, count(*) AS bookings
       FROM (SELECT DISTINCT property_id, booking_id, total_amount AS amount FROM viewed_bookings
             WHERE booking_status = 'confirmed')
       GROUP BY property_id""",
    doubles="revenue",
)
def property_revenue_clean(i: Inputs):
    m = i.market
    pairs = performance.viewer_pairs(m.silver_clickstream)
    facts = performance.booking_facts(m.tables, pairs, m.date_boundaries, i.config.today())
    return performance.property_revenue_clean(facts)


_LIFT_DOUBLES = " ".join(
    f"avg_{s}_with avg_{s}_without {s}_lift" for s in ("initiation", "confirmation", "completion")
)


@check("amenity_lift", "SELECT * FROM amenity_lift", doubles=_LIFT_DOUBLES)
def amenity_lift(i: Inputs):
    return i.market.amenity_lift


@check(
    "amenity_city_top", "SELECT * FROM amenity_ranks WHERE rank <= 3", doubles="confirmation_lift", bigints="rank"
)
def amenity_city_top(i: Inputs):
    return i.market.amenity_city_top


@check("device_funnel", "SELECT * FROM device_funnel", doubles="initiation_rate confirmation_rate completion_rate")
def device_funnel(i: Inputs):
    return i.market.device_funnel.withColumn("week_start", F.col("week_start").cast("date"))


@check(
    "device_diagnosis",
    "SELECT * FROM device_diagnosis",
    doubles="desktop_rate mobile_rate tablet_rate device_gap_pct",
)
def device_diagnosis(i: Inputs):
    return i.market.device_diagnosis


# ------------------------------------------------------------------------- exploration


@check(
    "bookings_temporal",
    """SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS month, count(*) AS booking_count,
              count(DISTINCT user_id) AS unique_users, count(DISTINCT property_id) AS unique_properties
       FROM bookings GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
)
def bookings_temporal(i: Inputs):
    return explore.bookings_temporal(i.tables.bookings)


@check(
    "user_booking_frequency",
    """SELECT bookings_per_user, count(*) AS user_count
       FROM (SELECT user_id, count(*) AS bookings_per_user FROM bookings GROUP BY user_id) GROUP BY 1""",
)
def user_booking_frequency(i: Inputs):
    return explore.user_booking_frequency(i.tables.bookings)


@check(
    "property_popularity",
    """SELECT property_id, count(*) AS booking_count, count(DISTINCT user_id) AS unique_users
       FROM bookings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def property_popularity(i: Inputs):
    return explore.property_popularity(i.tables.bookings)


@check(
    "clickstream_patterns",
    """SELECT event, device, referrer, count(*) AS count FROM clickstream GROUP BY ALL
       ORDER BY count DESC, event, device NULLS FIRST, referrer LIMIT 20""",
)
def clickstream_patterns(i: Inputs):
    return explore.clickstream_patterns(i.tables.clickstream)


# --------------------------------------------------------------------- generated traffic


@check(
    "event_window_config",
    """SELECT event_seq, nearest AS min_offset_seconds, farthest AS max_offset_seconds, count(*) AS planned_events
       FROM bookings CROSS JOIN event_windows GROUP BY ALL""",
    bigints="event_seq min_offset_seconds max_offset_seconds",
)
def event_window_config(i: Inputs):
    return synth.events_per_window(i.tables.bookings)


@check("synth_booking_events", "SELECT user_id, property_id, event, timestamp, device, referrer FROM booking_views")
def synth_booking_events(i: Inputs):
    return synth.booking_events(i.tables.bookings).select(
        "user_id", "property_id", "event", "timestamp", "metadata.*"
    )


@check(
    "synth_prelaunch_events", "SELECT user_id, property_id, event, timestamp, device, referrer FROM prelaunch_views"
)
def synth_prelaunch_events(i: Inputs):
    return synth.prelaunch_events(i.tables.bookings, i.config).select(
        "user_id", "property_id", "event", "timestamp", "metadata.*"
    )


@check(
    "synth_nonbooking_events", "SELECT user_id, property_id, event, timestamp, device, referrer FROM browse_views"
)
def synth_nonbooking_events(i: Inputs):
    return synth.browse_only_events(i.tables.bookings, i.config).select(
        "user_id", "property_id", "event", "timestamp", "metadata.*"
    )


# ---------------------------------------------------------------------------- validation


@check(
    "schema_compare",
    """SELECT t.column_name, t.kind AS template_type, t.n AS template_filled, o.kind AS other_type,
              o.n AS other_filled, t.kind = o.kind AS same_type
       FROM (SELECT unnest(['user_id', 'property_id', 'event', 'timestamp', 'metadata']) AS column_name,
                    unnest(['bigint', 'bigint', 'string', 'timestamp',
                            'struct<device:string,referrer:string>']) AS kind,
                    unnest([count(user_id), count(property_id), count(event), count(timestamp), count(*)]) AS n
             FROM clickstream) AS t
       JOIN (SELECT unnest(['user_id', 'property_id', 'event', 'timestamp', 'metadata']) AS column_name,
                    unnest(['bigint', 'bigint', 'string', 'timestamp',
                            'struct<device:string,referrer:string>']) AS kind,
                    unnest([count(user_id), count(property_id), count(event), count(timestamp), count(*)]) AS n
             FROM synthetic) AS o USING (column_name)""",
)
def schema_compare(i: Inputs):
    return validate.schema_compare(i.tables.clickstream, i.synthetic)


@check(
    "timestamp_range_compare",
    """SELECT 'synthetic' AS source, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
              count(DISTINCT property_id) AS unique_properties, min(timestamp) AS earliest_event,
              max(timestamp) AS latest_event FROM synthetic
       UNION ALL
       SELECT 'bookings', count(*), count(DISTINCT user_id), count(DISTINCT property_id), min(created_at),
              max(created_at) FROM bookings""",
)
def timestamp_range_compare(i: Inputs):
    return validate.timestamp_range_compare(i.synthetic, i.tables.bookings)


def _share_sql(*columns: str) -> str:
    names = ", ".join(columns)
    return f"""SELECT {names}, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
               FROM clickstream GROUP BY {names}"""


@check("event_distribution", _share_sql("event"), doubles="percentage")
def event_distribution(i: Inputs):
    return explore.event_distribution(i.tables.clickstream)


@check(
    "metadata_distribution",
    _share_sql("device", "referrer") + " ORDER BY count DESC, device NULLS FIRST, referrer LIMIT 20",
    doubles="percentage",
)
def metadata_distribution(i: Inputs):
    return explore.metadata_distribution(i.tables.clickstream, "device", "referrer", top=20)


@check("device_distribution", _share_sql("device"), doubles="percentage")
def device_distribution(i: Inputs):
    return explore.metadata_distribution(i.tables.clickstream, "device")


@check("referrer_distribution", _share_sql("referrer"), doubles="percentage")
def referrer_distribution(i: Inputs):
    return explore.metadata_distribution(i.tables.clickstream, "referrer")


@check(
    "events_per_booking",
    """SELECT count(*) AS total_bookings, round(avg(n), 2) AS avg_events_per_booking, min(n) AS min_events,
              max(n) AS max_events, count(*) FILTER (WHERE n = 0) AS bookings_without_events,
              count(*) FILTER (WHERE n >= 5 AND n <= 20) AS bookings_in_target_range
       FROM (SELECT k.booking_id, count(s.event) AS n FROM bookings AS k LEFT JOIN synthetic AS s
                 ON s.user_id = k.user_id AND s.property_id = k.property_id
                AND s.timestamp BETWEEN k.created_at - INTERVAL 30 DAY AND k.created_at
             GROUP BY k.booking_id)""",
    doubles="avg_events_per_booking",
)
def events_per_booking(i: Inputs):
    return validate.events_per_booking(i.tables.bookings, i.synthetic)


@check(
    "temporal_distribution",
    """SELECT CASE WHEN lead < 1 THEN '< 1 hour' WHEN lead < 24 THEN '1-24 hours' WHEN lead < 168 THEN '1-7 days'
                   WHEN lead < 672 THEN '1-4 weeks' ELSE '> 4 weeks' END AS time_window,
              count(*) AS event_count, count(DISTINCT booking_id) AS booking_count,
              round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
       FROM (SELECT k.booking_id,
                    (epoch_us(k.created_at) // 1000000 - epoch_us(s.timestamp) // 1000000) / 3600.0 AS lead
             FROM bookings AS k JOIN synthetic AS s ON s.user_id = k.user_id AND s.property_id = k.property_id
             WHERE s.timestamp <= k.created_at)
       GROUP BY 1""",
    doubles="percentage",
)
def temporal_distribution(i: Inputs):
    return validate.temporal_distribution(i.tables.bookings, i.synthetic)


@check(
    "invalid_events",
    """SELECT count(*) AS invalid_events FROM synthetic AS s JOIN bookings AS k
         ON k.user_id = s.user_id AND k.property_id = s.property_id AND s.timestamp > k.created_at""",
)
def invalid_events(i: Inputs):
    return validate.invalid_events(i.tables.bookings, i.synthetic)


@check(
    "clickstream_summary",
    """SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
              count(DISTINCT property_id) AS unique_properties, min(timestamp) AS min_timestamp,
              max(timestamp) AS max_timestamp FROM clickstream""",
)
def clickstream_summary(i: Inputs):
    return validate.clickstream_summary(i.tables.clickstream)


_SEGMENTS = """FROM (SELECT DISTINCT user_id FROM synthetic) AS v
       LEFT JOIN (SELECT DISTINCT user_id FROM bookings) AS k ON k.user_id = v.user_id"""


@check(
    "conversion_rate",
    f"""SELECT count(v.user_id) AS total_viewers, count(k.user_id) AS bookers,
               round(count(k.user_id) * 100.0 / count(v.user_id), 2) AS conversion_rate {_SEGMENTS}""",
    doubles="conversion_rate",
)
def conversion_rate(i: Inputs):
    return validate.conversion_rate(i.synthetic, i.tables.bookings)


@check(
    "user_segmentation",
    f"""SELECT count(v.user_id) AS total_viewers, count(k.user_id) AS users_who_booked,
               count(v.user_id) - count(k.user_id) AS users_who_didnt_book,
               round(count(k.user_id) * 100.0 / count(v.user_id), 2) AS conversion_rate_pct {_SEGMENTS}""",
    doubles="conversion_rate_pct",
)
def user_segmentation(i: Inputs):
    return validate.user_segmentation(i.synthetic, i.tables.bookings)


@check(
    "nonbooking_check",
    """SELECT count(DISTINCT s.user_id) AS non_booking_viewers,
              count(DISTINCT k.user_id) AS non_booking_users_with_bookings
       FROM synthetic AS s LEFT JOIN bookings AS k ON k.user_id = s.user_id WHERE s.user_id >= (SELECT floor FROM browse_floor)""",
)
def nonbooking_check(i: Inputs):
    return validate.nonbooking_check(i.synthetic, i.tables.bookings, i.config)


@check(
    "events_by_user_type",
    """SELECT CASE WHEN user_id >= (SELECT floor FROM browse_floor) THEN 'Non-Booking User' ELSE 'Booking User' END AS user_type,
              count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
              round(count(*) * 1.0 / count(DISTINCT user_id), 2) AS avg_events_per_user
       FROM synthetic GROUP BY 1""",
    doubles="avg_events_per_user",
)
def events_by_user_type(i: Inputs):
    return validate.events_by_user_type(i.synthetic, i.tables.bookings, i.config)


@check(
    "validation_verdicts",
    f"""WITH counts AS (
            SELECT k.booking_id, count(s.event) AS n FROM bookings AS k LEFT JOIN synthetic AS s
                ON s.user_id = k.user_id AND s.property_id = k.property_id
               AND s.timestamp BETWEEN k.created_at - INTERVAL 30 DAY AND k.created_at
            GROUP BY k.booking_id),
        late AS (
            SELECT count(*) AS n FROM synthetic AS s JOIN bookings AS k
                ON k.user_id = s.user_id AND k.property_id = s.property_id AND s.timestamp > k.created_at),
        segments AS (SELECT round(count(k.user_id) * 100.0 / count(v.user_id), 2) AS pct {_SEGMENTS}),
        strays AS (
            SELECT count(DISTINCT user_id) AS n FROM synthetic
            WHERE user_id >= (SELECT floor FROM browse_floor) AND user_id IN (SELECT user_id FROM bookings))
       SELECT 'all_events_are_views' AS check, count(*) = count(*) FILTER (WHERE event = 'view') AS passed,
              round(count(*) FILTER (WHERE event = 'view') * 100.0 / count(*), 2) AS measured FROM synthetic
       UNION ALL SELECT 'all_bookings_have_events', count(*) FILTER (WHERE n = 0) = 0,
                        count(*) FILTER (WHERE n = 0) FROM counts
       UNION ALL SELECT 'at_least_5_events', min(n) >= 5, min(n) FROM counts
       UNION ALL SELECT 'at_most_20_events', max(n) <= 20, max(n) FROM counts
       UNION ALL SELECT 'no_events_after_booking', n = 0, n FROM late
       UNION ALL SELECT 'conversion_42_to_46', pct >= 42 AND pct <= 46, pct FROM segments
       UNION ALL SELECT 'browse_only_users_never_book', n = 0, n FROM strays""",
    doubles="measured",
)
def validation_verdicts(i: Inputs):
    return validate.validation_verdicts(i.synthetic, i.tables.bookings, i.config)


# ------------------------------------------------------------------------------- quality


def _report_sql(dataset: str, source: str, action: str, **rules: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{name}' AS "constraint", '{action}' AS action,
                   count(*) FILTER (WHERE {rule}) AS passed,
                   count(*) - count(*) FILTER (WHERE {rule}) AS failed FROM {source}"""
        for name, rule in rules.items()
    )


_CLICK_REPORT = _report_sql(
    "silver_clickstream",
    "flat_clicks",
    "drop",
    valid_user_id="user_id IS NOT NULL",
    valid_event="event IN ('view', 'click', 'search', 'filter')",
)
_BOOKING_REPORT = " UNION ALL ".join(
    [
        _report_sql(
            "silver_bookings_enriched", "wide_bookings", "fail", required_booking_id="booking_id IS NOT NULL"
        ),
        _report_sql(
            "silver_bookings_enriched", "wide_bookings", "drop", required_property_id="property_id IS NOT NULL"
        ),
    ]
)
_FUNNEL_RULES = {
    "non_negative_viewers": "viewers >= 0",
    "non_negative_bookers": "initiated_bookers >= 0 AND confirmed_bookers >= 0 AND completers >= 0",
    "logical_funnel": "initiated_bookers >= confirmed_bookers AND confirmed_bookers >= completers",
}
_WARN_REPORT = " UNION ALL ".join(
    [
        _report_sql("city_funnel", "city_funnel", "warn", **_FUNNEL_RULES),
        _report_sql("device_funnel", "device_funnel", "warn", **_FUNNEL_RULES),
        _report_sql(
            "property_performance",
            "property_performance",
            "warn",
            valid_initiation_rate="initiation_rate BETWEEN 0 AND 100",
            valid_confirmation_rate="confirmation_rate BETWEEN 0 AND 100",
            valid_completion_rate="completion_rate BETWEEN 0 AND 100",
            logical_funnel="initiated_bookings >= confirmed_bookings AND confirmed_bookings >= completed_bookings",
        ),
        _report_sql(
            "amenity_lift",
            "amenity_lift",
            "warn",
            valid_amenity_data="properties_with > 0 OR properties_without > 0",
        ),
    ]
)


@check("quality_report", f"{_CLICK_REPORT} UNION ALL {_BOOKING_REPORT} UNION ALL {_WARN_REPORT}")
def quality_report_query(i: Inputs):
    """From the counts of the pass that writes the tables."""
    _, violations = refresh(i.market, i.folder("quality"))
    return quality_report(i.spark, violations)


@check("quality_drop", f"{_CLICK_REPORT}")
def quality_drop(i: Inputs):
    return report(silver.flat_clickstream(i.tables.clickstream), "silver_clickstream", silver.CLICKSTREAM_RULES)


@check(
    "quality_fail",
    "SELECT booking_id, property_id, booking_status, payment_status FROM silver_bookings",
)
def quality_fail(i: Inputs):
    """Passes the rows on; a NULL booking id would make the query itself fail."""
    return i.market.silver_bookings_enriched.select("booking_id", "property_id", "booking_status", "payment_status")


@check("quality_warn", _report_sql("city_funnel", "city_funnel", "warn", **_FUNNEL_RULES))
def quality_warn(i: Inputs):
    return report(i.market.city_funnel, "city_funnel", FUNNEL_RULES)
