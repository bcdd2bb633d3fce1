"""Single operators: scans, projections, filters, joins, aggregates, windows, functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from innmetrics.checks.registry import Inputs, check
from innmetrics.functions.measures import exact_mean, is_view, safe_rate
from innmetrics.operators.distinct import count_members
from innmetrics.operators.ranking import top_per_key
from innmetrics.operators.share import count_shares
from innmetrics.plans import explore, funnels, performance, segments, silver, synth, validate
from innmetrics.plans.amenity import property_conversion
from innmetrics.plans.monitoring import json_field, json_merge

# ---------------------------------------------------------------- scans and projections


@check("scan_bookings", "SELECT * FROM bookings", doubles="total_amount")
def scan_bookings(i: Inputs):
    return i.tables.bookings


@check(
    "project_bookings",
    "SELECT booking_id AS id, property_id AS stay, status AS booking_status, created_at AS booked_at FROM bookings",
)
def project_bookings(i: Inputs):
    return i.tables.bookings.select(
        F.col("booking_id").alias("id"),
        F.col("property_id").alias("stay"),
        F.col("status").alias("booking_status"),
        F.col("created_at").alias("booked_at"),
    )


@check("struct_access", "SELECT user_id, timestamp, device, referrer FROM clickstream")
def struct_access(i: Inputs):
    return i.tables.clickstream.select(
        "user_id",
        "timestamp",
        F.col("metadata.device").alias("device"),
        F.col("metadata.referrer").alias("referrer"),
    )


@check(
    "struct_build",
    """SELECT event, device, upper(coalesce(referrer, 'none')) AS source, count(*) AS events
       FROM clickstream GROUP BY ALL""",
)
def struct_build(i: Inputs):
    made = i.tables.clickstream.select(
        "event",
        F.struct(
            F.col("metadata.device").alias("device"),
            F.upper(F.coalesce("metadata.referrer", F.lit("none"))).alias("source"),
        ).alias("origin"),
    )
    return made.groupBy("event", "origin").agg(F.count("*").alias("events")).select("event", "origin.*", "events")


# ------------------------------------------------------------------------------ filters


@check(
    "filter_in",
    "SELECT user_id, property_id, event, timestamp FROM clickstream WHERE event = 'view' OR event = 'click'",
)
def filter_in(i: Inputs):
    return i.tables.clickstream.where(is_view()).select("user_id", "property_id", "event", "timestamp")


@check(
    "filter_null",
    "SELECT user_id, event, timestamp, device FROM clickstream WHERE property_id IS NULL AND device IS NOT NULL",
)
def filter_null(i: Inputs):
    flat = i.tables.clickstream.where(F.col("property_id").isNull() & F.col("metadata.device").isNotNull())
    return flat.select("user_id", "event", "timestamp", F.col("metadata.device").alias("device"))


@check(
    "filter_between",
    """SELECT booking_id, total_amount, check_in FROM bookings
       WHERE total_amount >= 10 AND total_amount <= 50
         AND check_in >= DATE '2024-01-08' AND check_in <= DATE '2024-01-21'""",
    doubles="total_amount",
)
def filter_between(i: Inputs):
    return i.tables.bookings.where(
        F.col("total_amount").between(10, 50)
        & F.col("check_in").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-21").cast("date"))
    ).select("booking_id", "total_amount", "check_in")


@check(
    "filter_compound",
    """SELECT property_id, count(*) AS extreme_reviews FROM reviews
       WHERE NOT is_deleted AND (rating < 2 OR rating >= 5) GROUP BY property_id""",
)
def filter_compound(i: Inputs):
    rating = F.col("rating")
    kept = i.tables.reviews.where((F.col("is_deleted") == F.lit(False)) & ((rating < 2) | (rating >= 5)))
    return kept.groupBy("property_id").agg(F.count("*").alias("extreme_reviews"))


@check(
    "filter_global_range",
    "SELECT user_id, property_id, event, timestamp, device, referrer FROM ranged_views",
)
def filter_global_range(i: Inputs):
    ranged = synth.within_booking_range(synth.booking_events(i.tables.bookings), i.tables.bookings)
    return ranged.select("user_id", "property_id", "event", "timestamp", "metadata.*")


@check(
    "case_bucket",
    """SELECT CASE WHEN total_amount < 20 THEN 'low' WHEN total_amount < 60 THEN 'mid' END AS bucket,
              count(*) AS bookings
       FROM bookings GROUP BY ALL""",
)
def case_bucket(i: Inputs):
    amount = F.col("total_amount")
    bucket = F.when(amount < 20, "low").when(amount < 60, "mid").alias("bucket")
    return i.tables.bookings.groupBy(bucket).agg(F.count("*").alias("bookings"))


@check(
    "coalesce_keys",
    """SELECT coalesce(c.user_id, k.user_id) AS user_id, coalesce(clicks, 0) AS clicks,
              coalesce(orders, 0) AS orders
       FROM (SELECT user_id, count(*) AS clicks FROM silver_clicks GROUP BY 1) AS c
       FULL JOIN (SELECT user_id, count(*) AS orders FROM bookings GROUP BY 1) AS k
         ON k.user_id = c.user_id""",
)
def coalesce_keys(i: Inputs):
    clicks = (
        i.market.silver_clickstream.groupBy("user_id").agg(F.count("*").alias("clicks"))
    )
    orders = (
        i.tables.bookings
        .groupBy(F.col("user_id").alias("booker_id"))
        .agg(F.count("*").alias("orders"))
    )
    return clicks.join(orders, F.col("user_id") == F.col("booker_id"), "full").select(
        F.coalesce("user_id", "booker_id").alias("user_id"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
    )


@check("distinct_pairs", "SELECT user_id, property_id FROM bookings GROUP BY ALL")
def distinct_pairs(i: Inputs):
    return i.tables.bookings.select("user_id", "property_id").distinct()


@check(
    "agg_post_filter",
    """SELECT property_id, count(*) AS bookings, count(DISTINCT user_id) AS guests FROM bookings
       GROUP BY property_id HAVING count(*) > count(DISTINCT user_id)""",
)
def agg_post_filter(i: Inputs):
    return (
        i.tables.bookings.groupBy("property_id")
        .agg(F.count("*").alias("bookings"), F.countDistinct("user_id").alias("guests"))
        .where("bookings > guests")
    )


@check(
    "safe_rate",
    """SELECT property_id, count(*) FILTER (WHERE event = 'view') AS views,
              count(*) FILTER (WHERE event = 'click') AS clicks,
              CASE WHEN count(*) FILTER (WHERE event = 'view') > 0
                   THEN count(*) FILTER (WHERE event = 'click') * 100.0 / count(*) FILTER (WHERE event = 'view')
                   ELSE 0 END AS click_rate
       FROM silver_clicks GROUP BY property_id""",
    doubles="click_rate",
)
def safe_rate_query(i: Inputs):
    counts = i.market.silver_clickstream.groupBy("property_id").agg(
        F.count_if(F.col("event") == "view").alias("views"), F.count_if(F.col("event") == "click").alias("clicks")
    )
    return counts.withColumn("click_rate", safe_rate(F.col("clicks"), F.col("views")))


# -------------------------------------------------------------------------------- joins


@check(
    "join_inner",
    """SELECT booking_id, l.property_id, city, country, o.name AS host_name FROM bookings AS k
       JOIN located AS l ON l.property_id = k.property_id JOIN hosts AS o ON o.host_id = l.host_id""",
)
def join_inner(i: Inputs):
    listed = silver.listings(i.tables).select("property_id", "city", "country", "host_name")
    return i.tables.bookings.select("booking_id", "property_id").join(listed, "property_id")


@check(
    "join_left",
    """SELECT k.booking_id, k.status, p.status AS payment_status, p.amount AS payment_amount
       FROM bookings AS k LEFT JOIN payments AS p ON p.booking_id = k.booking_id""",
    doubles="payment_amount",
)
def join_left(i: Inputs):
    return silver.paid_bookings(i.tables).select("booking_id", "status", "payment_status", "payment_amount")


@check(
    "join_full_chain",
    """SELECT coalesce(v.property_id, c.property_id, k.property_id, r.property_id) AS property_id,
              coalesce(v.n, 0) AS views, coalesce(c.n, 0) AS clicks, coalesce(k.n, 0) AS bookings,
              coalesce(r.n, 0) AS reviews
       FROM (SELECT property_id, count(*) AS n FROM silver_clicks
             WHERE event = 'view' AND property_id IS NOT NULL GROUP BY 1) AS v
       FULL JOIN (SELECT property_id, count(*) AS n FROM silver_clicks
                  WHERE event = 'click' AND property_id IS NOT NULL GROUP BY 1) AS c
              ON c.property_id = v.property_id
       FULL JOIN (SELECT property_id, count(*) AS n FROM bookings GROUP BY 1) AS k
              ON k.property_id = coalesce(v.property_id, c.property_id)
       FULL JOIN (SELECT property_id, count(*) AS n FROM reviews GROUP BY 1) AS r
              ON r.property_id = coalesce(v.property_id, c.property_id, k.property_id)""",
)
def join_full_chain(i: Inputs):
    """Counts from several tables per key, stacked and added up in one shuffle."""
    clicks = i.market.silver_clickstream
    parts = {
        "views": clicks.where("event = 'view'"),
        "clicks": clicks.where("event = 'click'"),
        "bookings": i.tables.bookings,
        "reviews": i.tables.reviews,
    }
    stacked = None
    for name, rows in parts.items():
        tagged = rows.where("property_id IS NOT NULL").select("property_id", F.lit(name).alias("part"))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return stacked.groupBy("property_id").agg(*[F.count_if(F.col("part") == name).alias(name) for name in parts])


@check(
    "join_cross_scalar",
    """SELECT booking_id, booking_date, total_amount / mean_amount AS relative_amount
       FROM (SELECT DISTINCT booking_id, booking_date, CAST(total_amount AS DOUBLE) AS total_amount
             FROM silver_bookings CROSS JOIN bounds WHERE booking_date BETWEEN min_date AND max_date)
       CROSS JOIN (SELECT avg(CAST(total_amount AS DOUBLE)) AS mean_amount FROM bookings)""",
    doubles="relative_amount",
)
def join_cross_scalar(i: Inputs):
    """One-row tables enter as scalar subqueries."""
    mean = i.tables.bookings.agg(exact_mean(F.col("total_amount")).alias("mean_amount")).scalar()
    return (
        i.market.silver_bookings_enriched.where(silver.in_booking_window("booking_date", i.market.date_boundaries))
        .select("booking_id", "booking_date", "total_amount")
        .distinct()
        .select(
            "booking_id",
            "booking_date",
            (F.col("total_amount").cast("double") / mean).alias("relative_amount"),
        )
    )


@check(
    "join_multi_key",
    """SELECT k.booking_id, k.user_id, k.property_id, count(*) AS touches
       FROM bookings AS k JOIN silver_clicks AS s
         ON s.user_id = k.user_id AND s.property_id = k.property_id AND s.event IN ('view', 'click')
       GROUP BY ALL""",
)
def join_multi_key(i: Inputs):
    pairs = performance.viewer_pairs(i.market.silver_clickstream)
    return i.tables.bookings.select("booking_id", "user_id", "property_id").join(pairs, ["user_id", "property_id"])


@check(
    "join_interval_24h",
    """SELECT booking_id, count(*) AS touches FROM bookings AS k JOIN silver_clicks AS s
         ON s.user_id = k.user_id AND s.device IS NOT NULL AND s.timestamp <= k.created_at
        AND s.timestamp >= k.created_at - INTERVAL 24 HOUR
       GROUP BY booking_id""",
)
def join_interval_24h(i: Inputs):
    return validate.touches_in_window(i.tables.bookings, i.market.silver_clickstream.where("device IS NOT NULL"))


@check(
    "last_touch",
    """SELECT booking_id, user_id, city, device, timestamp, payment_status FROM attributed""",
)
def last_touch(i: Inputs):
    m = i.market
    return funnels.attributed_bookings(
        m.tables, m.silver_clickstream, m.silver_bookings_enriched, m.date_boundaries, i.config
    ).select("booking_id", "user_id", "city", "device", "timestamp", "payment_status")


@check(
    "bridge_membership",
    """SELECT a.amenity_id, a.name, count(*) FILTER (WHERE own.property_id IS NOT NULL) AS properties_with,
              count(*) FILTER (WHERE own.property_id IS NULL) AS properties_without
       FROM amenities AS a CROSS JOIN properties AS p LEFT JOIN property_amenities AS own
         ON own.amenity_id = a.amenity_id AND own.property_id = p.property_id
       GROUP BY ALL""",
)
def bridge_membership(i: Inputs):
    """Membership counts from the bridge; the rest of the properties are those without."""
    known = i.tables.properties.select("property_id")
    members = (
        i.tables.property_amenities.distinct()
        .join(known, "property_id", "left_semi")
        .groupBy("amenity_id")
        .agg(F.count("*").alias("properties_with"))
    )
    total = known.agg(F.count("*").alias("n")).scalar()
    having = F.coalesce("properties_with", F.lit(0))
    return i.tables.amenities.join(members, "amenity_id", "left").select(
        "amenity_id", "name", having.alias("properties_with"), (total - having).alias("properties_without")
    )


@check(
    "join_subquery",
    """SELECT property_id, city, property_type, initiation, confirmation, completion
       FROM property_conversion WHERE initiation IS NOT NULL""",
    doubles="initiation confirmation completion",
)
def join_subquery(i: Inputs):
    m = i.market
    return property_conversion(m.tables, m.viewer_pairs, m.date_boundaries, i.config)


@check(
    "join_semi",
    """SELECT booking_id, user_id, property_id, status FROM bookings AS k
       WHERE EXISTS (SELECT 1 FROM silver_clicks AS s WHERE s.user_id = k.user_id
                     AND s.property_id = k.property_id AND s.event IN ('view', 'click'))""",
)
def join_semi(i: Inputs):
    pairs = performance.viewer_pairs(i.market.silver_clickstream)
    return i.tables.bookings.join(pairs, ["user_id", "property_id"], "left_semi").select(
        "booking_id", "user_id", "property_id", "status"
    )


# --------------------------------------------------------------------------- aggregates


@check(
    "agg_count",
    """SELECT event, count(*) AS rows_all, count(user_id) AS with_user, count(device) AS with_device
       FROM clickstream GROUP BY event""",
)
def agg_count(i: Inputs):
    return i.tables.clickstream.groupBy("event").agg(
        F.count("*").alias("rows_all"),
        F.count("user_id").alias("with_user"),
        F.count("metadata.device").alias("with_device"),
    )


@check(
    "agg_count_distinct",
    """SELECT status, count(DISTINCT user_id) AS users FROM bookings GROUP BY status""",
)
def agg_count_distinct(i: Inputs):
    return i.tables.bookings.groupBy("status").agg(F.countDistinct("user_id").alias("users"))


@check(
    "agg_cond_distinct",
    """SELECT property_id, count(DISTINCT CASE WHEN event = 'view' THEN user_id END) AS viewers,
              count(DISTINCT CASE WHEN event = 'click' THEN user_id END) AS clickers,
              count(DISTINCT CASE WHEN event IN ('search', 'filter') THEN user_id END) AS seekers
       FROM silver_clicks GROUP BY property_id""",
)
def agg_cond_distinct(i: Inputs):
    event = F.col("event")
    flags = {"viewers": event == "view", "clickers": event == "click", "seekers": event.isin("search", "filter")}
    return count_members(i.market.silver_clickstream, ["property_id"], "user_id", flags)


@check(
    "agg_cond_count",
    """SELECT property_id, count(CASE WHEN event IN ('view', 'click') THEN 1 END) AS views
       FROM silver_clicks GROUP BY property_id""",
)
def agg_cond_count(i: Inputs):
    return i.market.silver_clickstream.groupBy("property_id").agg(F.count_if(is_view()).alias("views"))


@check(
    "agg_cond_sum",
    """SELECT property_id, sum(CASE WHEN status = 'confirmed' THEN total_amount ELSE 0 END) AS confirmed_amount
       FROM bookings GROUP BY property_id""",
    doubles="confirmed_amount",
)
def agg_cond_sum(i: Inputs):
    amount = F.when(F.col("status") == "confirmed", F.col("total_amount")).otherwise(0)
    return i.tables.bookings.groupBy("property_id").agg(F.sum(amount).alias("confirmed_amount"))


@check(
    "agg_sum",
    "SELECT status, sum(total_amount) AS amount, sum(booking_id % 7) AS checksum FROM bookings GROUP BY status",
    doubles="amount",
    bigints="checksum",
)
def agg_sum(i: Inputs):
    return i.tables.bookings.groupBy("status").agg(
        F.sum("total_amount").alias("amount"), F.sum(F.col("booking_id") % 7).alias("checksum")
    )


@check(
    "agg_cond_avg",
    """SELECT property_id, CAST(sum(total_amount) FILTER (WHERE status = 'completed') AS DOUBLE)
                           / nullif(count(*) FILTER (WHERE status = 'completed'), 0) AS completed_mean
       FROM bookings GROUP BY property_id""",
    doubles="completed_mean",
)
def agg_cond_avg(i: Inputs):
    completed = F.when(F.col("status") == "completed", F.col("total_amount"))
    return i.tables.bookings.groupBy("property_id").agg(
        exact_mean(completed).alias("completed_mean")
    )


@check(
    "agg_min_max",
    """SELECT event, min(event_date) AS first_day, max(event_date) AS last_day, min(timestamp) AS first_time,
              max(timestamp) AS last_time, min(user_id) AS low_user, max(user_id) AS high_user
       FROM silver_clicks GROUP BY event""",
)
def agg_min_max(i: Inputs):
    return i.market.silver_clickstream.groupBy("event").agg(
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
        F.min("user_id").alias("low_user"),
        F.max("user_id").alias("high_user"),
    )


@check("agg_percentile", "SELECT * FROM city_medians", doubles="median_viewers median_conversion")
def agg_percentile(i: Inputs):
    return segments.city_medians(segments.city_totals(i.market.city_funnel))


@check(
    "agg_pivot",
    """SELECT property_id, max(CASE WHEN device = 'desktop' THEN n ELSE 0 END) AS desktop,
              max(CASE WHEN device = 'mobile' THEN n ELSE 0 END) AS mobile,
              max(CASE WHEN device = 'tablet' THEN n ELSE 0 END) AS tablet
       FROM (SELECT property_id, device, count(*) AS n FROM silver_clicks GROUP BY ALL) GROUP BY property_id""",
)
def agg_pivot(i: Inputs):
    counts = i.market.silver_clickstream.groupBy("property_id").agg(
        *[F.count_if(F.col("device") == device).alias(device) for device in ("desktop", "mobile", "tablet")]
    )
    return counts


@check(
    "agg_group_expr",
    """SELECT CAST(created_at AS DATE) AS booking_day, status, count(*) AS bookings
       FROM bookings GROUP BY 1, 2""",
)
def agg_group_expr(i: Inputs):
    return i.tables.bookings.groupBy(F.to_date("created_at").alias("booking_day"), "status").agg(
        F.count("*").alias("bookings")
    )


# ------------------------------------------------------------- windows, samples, unions


@check(
    "win_row_number",
    """SELECT city, property_type, amenity_name, round(confirmation_lift, 6) AS confirmation_lift, rank
       FROM amenity_ranks""",
)
def win_row_number(i: Inputs):
    order = [F.col("confirmation_lift").desc(), F.col("amenity_id")]
    ranks = F.row_number().over(Window.partitionBy("city", "property_type").orderBy(*order))
    ranked = i.market.amenity_lift.withColumn("rank", ranks)
    return ranked.select("city", "property_type", "amenity_name", "confirmation_lift", "rank")


@check(
    "win_first_last",
    """SELECT city, device, max(confirmation_rate) FILTER (WHERE up = 1) AS first_rate,
              max(confirmation_rate) FILTER (WHERE down = 1) AS last_rate
       FROM (SELECT *, row_number() OVER (PARTITION BY city, device ORDER BY week_start) AS up,
                    row_number() OVER (PARTITION BY city, device ORDER BY week_start DESC) AS down
             FROM device_funnel)
       GROUP BY ALL""",
    doubles="first_rate last_rate",
)
def win_first_last(i: Inputs):
    week = F.struct("week_start")
    return i.market.device_funnel.groupBy("city", "device").agg(
        F.min_by("confirmation_rate", week).alias("first_rate"),
        F.max_by("confirmation_rate", week).alias("last_rate"),
    )


@check(
    "win_share",
    """SELECT event, device, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
       FROM silver_clicks GROUP BY event, device""",
    doubles="percentage",
)
def win_share(i: Inputs):
    return count_shares(i.market.silver_clickstream, ["event", "device"])


@check("sample_pairs", "SELECT user_id, property_id FROM sampled_pairs")
def sample_pairs(i: Inputs):
    return synth.sample_pairs(i.tables.bookings, i.config.prelaunch_pairs)


@check(
    "union_events",
    "SELECT user_id, property_id, event, timestamp, device, referrer FROM synthetic",
)
def union_events(i: Inputs):
    return i.synthetic.select("user_id", "property_id", "event", "timestamp", "metadata.*")


# ---------------------------------------------------------------------- scalar functions


@check("fn_date", "SELECT booking_id, CAST(created_at AS DATE) AS booking_day FROM bookings")
def fn_date(i: Inputs):
    return i.tables.bookings.select("booking_id", F.to_date("created_at").alias("booking_day"))


@check(
    "fn_date_trunc",
    """SELECT booking_id, CAST(date_trunc('week', created_at) AS DATE) AS week_start,
              CAST(date_trunc('month', created_at) AS DATE) AS month_start FROM bookings""",
)
def fn_date_trunc(i: Inputs):
    return i.tables.bookings.select(
        "booking_id",
        F.date_trunc("week", "created_at").cast("date").alias("week_start"),
        F.date_trunc("month", "created_at").cast("date").alias("month_start"),
    )


@check("fn_timestampadd", "SELECT booking_id, created_at - INTERVAL 24 HOUR AS day_before FROM bookings")
def fn_timestampadd(i: Inputs):
    return i.tables.bookings.select(
        "booking_id", F.timestamp_add("HOUR", F.lit(-24), F.col("created_at")).alias("day_before")
    )


@check(
    "fn_datediff",
    "SELECT booking_id, CAST(check_in - CAST(created_at AS DATE) AS BIGINT) AS days_ahead FROM bookings",
)
def fn_datediff(i: Inputs):
    return i.tables.bookings.select(
        "booking_id", F.datediff("check_in", F.to_date("created_at")).alias("days_ahead")
    )


@check(
    "fn_interval",
    """SELECT booking_id, created_at - INTERVAL 30 DAY AS month_before,
              created_at - INTERVAL 10 SECOND AS just_before FROM bookings""",
)
def fn_interval(i: Inputs):
    return i.tables.bookings.select(
        "booking_id",
        (F.col("created_at") - F.expr("INTERVAL 30 DAYS")).alias("month_before"),
        (F.col("created_at") - F.expr("INTERVAL 10 SECONDS")).alias("just_before"),
    )


@check(
    "fn_epoch_hours",
    """SELECT booking_id, (epoch_us(CAST(check_in AS TIMESTAMP)) // 1000000 - epoch_us(created_at) // 1000000) / 3600.0
              AS hours_ahead FROM bookings""",
    doubles="hours_ahead",
)
def fn_epoch_hours(i: Inputs):
    seconds = F.unix_timestamp("check_in") - F.unix_timestamp("created_at")
    return i.tables.bookings.select("booking_id", (seconds / 3600).alias("hours_ahead"))


@check(
    "fn_cast_ts",
    """SELECT booking_id, epoch_us(created_at) // 1000000 AS seconds,
              make_timestamp((epoch_us(created_at) // 1000000 - 90) * 1000000) AS earlier FROM bookings""",
)
def fn_cast_ts(i: Inputs):
    seconds = F.col("created_at").cast("long")
    return i.tables.bookings.select(
        "booking_id", seconds.alias("seconds"), (seconds - 90).cast("timestamp").alias("earlier")
    )


@check(
    "fn_math",
    """SELECT booking_id, CAST(floor(total_amount / 7) AS BIGINT) AS sevens,
              total_amount * 2 - 1 + 0.5 AS mixed FROM bookings""",
    doubles="mixed",
)
def fn_math(i: Inputs):
    amount = F.col("total_amount")
    return i.tables.bookings.select(
        "booking_id", F.floor(amount / 7).cast("bigint").alias("sevens"), (amount * 2 - 1 + 0.5).alias("mixed")
    )


@check(
    "fn_round",
    "SELECT booking_id, round(total_amount, 1) AS tenths, round(total_amount, 0) AS whole FROM bookings",
    doubles="tenths whole",
)
def fn_round(i: Inputs):
    return i.tables.bookings.select(
        "booking_id", F.round("total_amount", 1).alias("tenths"), F.round("total_amount", 0).alias("whole")
    )


@check(
    "fn_explode",
    "SELECT booking_id, n AS event_num FROM bookings CROSS JOIN range(10) AS r(n)",
)
def fn_explode(i: Inputs):
    return i.tables.bookings.select(
        "booking_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("event_num")
    )


@check(
    "fn_json_field",
    "SELECT event_id, props->>'k' AS k FROM events WHERE props->>'k' = '7'",
)
def fn_json_field(i: Inputs):
    k = json_field("props", "k")
    return i.raw("events").where(k == "7").select("event_id", k.alias("k"))


@check(
    "fn_json_merge",
    """SELECT event_id, CAST(json_merge_patch(props::JSON,
                '{"options": {"late": false}, "score": 1.5, "tags": ["a", 2, null], "verified": true}'::JSON) AS VARCHAR) AS props
       FROM events""",
)
def fn_json_merge(i: Inputs):
    """The whole value is compared, so types count."""
    added = {"verified": True, "score": 1.5, "tags": ["a", 2, None], "options": {"late": False}}
    return i.raw("events").select("event_id", json_merge("props", added).alias("props"))


@check(
    "sample_bookings",
    """SELECT booking_id, user_id, property_id, created_at, check_in, check_out, status,
              CAST(check_in - CAST(created_at AS DATE) AS BIGINT) AS days_advance_booking
       FROM bookings WHERE created_at >= TIMESTAMP '2024-01-10' ORDER BY created_at DESC, booking_id LIMIT 10""",
)
def sample_bookings(i: Inputs):
    return explore.sample_bookings(i.tables.bookings, since=datetime(2024, 1, 10))
