"""Building blocks of the check SQL: named sub-queries in plain SQL over the test tables.

They spell out the definitions in the most direct form (row-by-row joins, crossings,
window ranks), not the way the Spark plans compute them.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2024-01-20'"


MODULUS = 2_147_483_647


def r6(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def rate(part: str, whole: str, above: int = 0, otherwise: str = "0") -> str:
    return f"CASE WHEN coalesce({whole}, 0) > {above} THEN coalesce({part}, 0) * 100.0 / {whole} ELSE {otherwise} END"


def draw(stream: int, *ids: str) -> str:
    """The arithmetic draw of the generated data; see the draw functions of the package."""
    m = MODULUS
    terms = [
        f"((({x} + {x} // {m} * 611953) % {m} + {m}) % {m}) * {7919 + 7907 * stream + 104_729 * i}"
        for i, x in enumerate(ids)
    ]
    mixed = f"(({' + '.join(terms)} + {15_485_863 * (stream + 1)}) % {m})"
    square = f"({mixed} * {mixed} % {m})"
    return f"(({square} * {square} % {m}) * {mixed} % {m})"


def scaled(stream: int, span: str | int, *ids: str) -> str:
    return f"({draw(stream, *ids)} * CAST({span} AS BIGINT) // {MODULUS})"


def below(stream: int, share: float, *ids: str) -> str:
    return f"{draw(stream, *ids)} < {round(share * MODULUS)}"


def chained_device(stream: int, *ids: str) -> str:
    return (
        f"CASE WHEN {below(stream, 0.50, *ids)} THEN 'mobile' "
        f"WHEN {below(stream + 1, 0.75, *ids)} THEN 'desktop' ELSE 'tablet' END"
    )


def chained_referrer(stream: int, *ids: str) -> str:
    return (
        f"CASE WHEN {below(stream, 0.40, *ids)} THEN 'google' WHEN {below(stream + 1, 0.65, *ids)} THEN 'direct' "
        f"WHEN {below(stream + 2, 0.85, *ids)} THEN 'ad' ELSE 'email' END"
    )


def choose(stream: int, shares: list[tuple[str, float]], *ids: str) -> str:
    cases, reached = [], 0.0
    for value, share in shares[:-1]:
        reached += share
        cases.append(f"WHEN {below(stream, reached, *ids)} THEN '{value}'")
    return f"CASE {' '.join(cases)} ELSE '{shares[-1][0]}' END"


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
CONFIRMED = "booking_status IN ('confirmed', 'completed')"
COMPLETED = f"booking_status = 'completed' AND payment_status = 'completed' AND check_out < {AS_OF}"

PARTS: dict[str, str] = {
    # --- input tables -----------------------------------------------------------------
    "clickstream": f"""
        SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id,
               CASE WHEN event_id % 41 <> 0 THEN {_K} END AS property_id,
               CASE WHEN event_id % 37 = 0 THEN 'hover' WHEN event_type = 'signup' THEN 'search'
                    WHEN event_type = 'error' THEN 'filter' ELSE event_type END AS event,
               ts AS timestamp,
               CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 10 < 5 THEN 'mobile'
                    WHEN event_id % 10 < 8 THEN 'desktop' ELSE 'tablet' END AS device,
               CASE WHEN event_id % 20 < 8 THEN 'google' WHEN event_id % 20 < 13 THEN 'direct'
                    WHEN event_id % 20 < 17 THEN 'ad' ELSE 'email' END AS referrer
        FROM events WHERE event_type <> 'purchase'""",
    "bookings": f"""
        SELECT event_id AS booking_id, user_id, {_K} AS property_id,
               CASE WHEN event_id % 10 = 0 THEN 'pending' WHEN event_id % 10 <= 2 THEN 'cancelled'
                    WHEN event_id % 10 <= 5 THEN 'confirmed' ELSE 'completed' END AS status,
               CAST(value AS DECIMAL(12,2)) AS total_amount, ts AS created_at,
               CAST(ts AS DATE) + CAST(event_id % 5 + 1 AS INTEGER) AS check_in,
               CAST(ts AS DATE) + CAST(event_id % 5 + event_id % 4 + 2 AS INTEGER) AS check_out
        FROM events WHERE event_type = 'purchase'""",
    "payments": """
        SELECT event_id * 10 AS payment_id, event_id AS booking_id,
               CASE WHEN event_id % 11 = 0 THEN 'failed' WHEN event_id % 13 = 0 THEN 'pending'
                    ELSE 'completed' END AS status,
               CASE WHEN event_id % 3 = 0 THEN 'card' ELSE 'wallet' END AS payment_method,
               CAST(value AS DECIMAL(12,2)) AS amount
        FROM events WHERE event_type = 'purchase' AND event_id % 7 <> 0
        UNION ALL
        SELECT event_id * 10 + 1, event_id, 'completed', 'card', CAST(value AS DECIMAL(12,2))
        FROM events WHERE event_type = 'purchase' AND event_id % 7 <> 0 AND event_id % 11 = 0""",
    "properties": """
        SELECT p_partkey AS property_id, p_name AS title, p_type AS property_type,
               p_retailprice AS base_price, p_partkey % 5 AS destination_id, p_partkey % 10 AS host_id
        FROM part""",
    "destinations": """
        SELECT CAST(n_nationkey AS BIGINT) AS destination_id, n_name AS destination, r_name AS country
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "hosts": """
        SELECT s_suppkey AS host_id, s_name AS name, CAST(s_suppkey % 5 + 1 AS DOUBLE) AS rating,
               s_suppkey % 2 = 0 AS is_verified
        FROM supplier""",
    "amenities": """
        SELECT CAST(n_nationkey AS BIGINT) AS amenity_id, n_name AS name,
               CAST(n_regionkey AS VARCHAR) AS category
        FROM nation""",
    "property_amenities": """
        SELECT DISTINCT l_partkey AS property_id, l_suppkey % 25 AS amenity_id FROM lineitem""",
    "reviews": """
        SELECT l_partkey AS property_id, CAST(l_quantity % 5 + 1 AS DOUBLE) AS rating,
               l_returnflag = 'R' AS is_deleted
        FROM lineitem""",
    # --- silver -----------------------------------------------------------------------
    "flat_clicks": """
        SELECT *, CAST(timestamp AS DATE) AS event_date FROM clickstream""",
    "silver_clicks": """
        SELECT user_id, property_id, event, timestamp, device, referrer, event_date
        FROM flat_clicks
        WHERE user_id IS NOT NULL AND event IN ('view', 'click', 'search', 'filter')""",
    "located": """
        SELECT property_id, title, property_type, base_price, host_id, destination_id,
               destination AS city, country
        FROM properties JOIN destinations USING (destination_id)""",
    "wide_bookings": """
        SELECT k.booking_id, k.user_id, k.property_id, k.status AS booking_status, k.total_amount,
               k.created_at AS booking_created_at, k.check_in, k.check_out,
               CAST(k.created_at AS DATE) AS booking_date, pay.status AS payment_status,
               pay.payment_method, pay.amount AS payment_amount, l.destination_id, l.property_type,
               l.base_price, l.host_id, l.title AS property_title, o.rating AS host_rating,
               o.is_verified AS host_verified, o.name AS host_name, l.city, l.country
        FROM bookings AS k
        JOIN located AS l ON l.property_id = k.property_id
        JOIN hosts AS o ON o.host_id = l.host_id
        LEFT JOIN payments AS pay ON pay.booking_id = k.booking_id""",
    "silver_bookings": """
        SELECT * FROM wide_bookings WHERE property_id IS NOT NULL""",
    "bounds": """
        SELECT min(event_date) AS min_date, max(event_date) AS max_date FROM silver_clicks""",
    "window_bookings": """
        SELECT * FROM silver_bookings
        WHERE booking_date >= (SELECT min_date FROM bounds) AND booking_date <= (SELECT max_date FROM bounds)""",
    # --- gold -------------------------------------------------------------------------
    "city_funnel": f"""
        SELECT city, event_date,
               coalesce(viewers, 0) AS viewers, coalesce(clickers, 0) AS clickers,
               coalesce(searchers, 0) AS searchers, coalesce(filterers, 0) AS filterers,
               coalesce(initiated_bookers, 0) AS initiated_bookers,
               coalesce(confirmed_bookers, 0) AS confirmed_bookers, coalesce(completers, 0) AS completers
        FROM (
            SELECT city, event_date,
                   count(DISTINCT user_id) FILTER (WHERE event = 'view') AS viewers,
                   count(DISTINCT user_id) FILTER (WHERE event = 'click') AS clickers,
                   count(DISTINCT user_id) FILTER (WHERE event = 'search') AS searchers,
                   count(DISTINCT user_id) FILTER (WHERE event = 'filter') AS filterers
            FROM silver_clicks JOIN located USING (property_id)
            GROUP BY ALL) AS traffic
        FULL JOIN (
            SELECT city, booking_date AS event_date,
                   count(DISTINCT user_id) AS initiated_bookers,
                   count(DISTINCT user_id) FILTER (WHERE {CONFIRMED}) AS confirmed_bookers,
                   count(DISTINCT user_id) FILTER (WHERE {COMPLETED}) AS completers
            FROM window_bookings
            GROUP BY ALL) AS booked USING (city, event_date)""",
    "city_totals": f"""
        SELECT city, {big("sum(viewers)")} AS total_viewers, {big("sum(completers)")} AS total_completers,
               {rate("sum(completers)", "sum(viewers)")} AS conversion_rate
        FROM city_funnel GROUP BY city""",
    "city_medians": """
        SELECT quantile_cont(CAST(total_viewers AS DOUBLE), 0.5) AS median_viewers,
               quantile_cont(CAST(conversion_rate AS DOUBLE), 0.5) AS median_conversion
        FROM city_totals""",
    "city_investment": """
        SELECT city, total_viewers, total_completers, conversion_rate,
               total_completers * (SELECT avg(CAST(total_amount AS DOUBLE)) FROM silver_bookings
                                   WHERE booking_status = 'confirmed') AS estimated_revenue,
               CASE WHEN total_viewers < median_viewers AND conversion_rate < median_conversion THEN 'Deprioritize'
                    WHEN total_viewers < median_viewers THEN 'Invest Marketing'
                    WHEN conversion_rate < median_conversion THEN 'Fix Supply/UX'
                    ELSE 'Protect & Expand' END AS quadrant
        FROM city_totals, city_medians""",
    "viewed_bookings": """
        SELECT w.* FROM window_bookings AS w
        JOIN silver_clicks AS s ON s.user_id = w.user_id AND s.property_id = w.property_id
                               AND s.event IN ('view', 'click')""",
    "traffic": """
        SELECT property_id, count(*) AS views, count(DISTINCT user_id) AS unique_viewers
        FROM silver_clicks WHERE event IN ('view', 'click') AND property_id IS NOT NULL
        GROUP BY property_id""",
    "booking_stats": f"""
        SELECT property_id, count(DISTINCT booking_id) AS initiated_bookings,
               count(DISTINCT booking_id) FILTER (WHERE {CONFIRMED}) AS confirmed_bookings,
               count(DISTINCT booking_id) FILTER (WHERE {COMPLETED}) AS completed_bookings,
               count(DISTINCT booking_id) FILTER (WHERE booking_status = 'cancelled') AS cancelled_bookings,
               coalesce(sum(total_amount) FILTER (WHERE booking_status = 'confirmed'), 0) AS total_revenue
        FROM viewed_bookings GROUP BY property_id""",
    "payment_stats": """
        SELECT k.property_id, count(DISTINCT payment_id) AS total_payments,
               count(DISTINCT payment_id) FILTER (WHERE pay.status = 'failed') AS failed_payments
        FROM bookings AS k JOIN payments AS pay USING (booking_id)
        JOIN silver_clicks AS s ON s.user_id = k.user_id AND s.property_id = k.property_id
        WHERE s.event IN ('view', 'click')
          AND CAST(k.created_at AS DATE) >= (SELECT min_date FROM bounds)
          AND CAST(k.created_at AS DATE) <= (SELECT max_date FROM bounds)
        GROUP BY k.property_id""",
    "review_stats": """
        SELECT property_id, avg(rating) AS avg_review_rating, count(*) AS review_count
        FROM reviews WHERE NOT is_deleted GROUP BY property_id""",
    "performance_counts": f"""
        SELECT l.*, o.name AS host_name, o.rating AS host_rating, o.is_verified AS host_verified,
               views, unique_viewers,
               coalesce(initiated_bookings, 0) AS initiated_bookings,
               coalesce(confirmed_bookings, 0) AS confirmed_bookings,
               coalesce(completed_bookings, 0) AS completed_bookings,
               coalesce(cancelled_bookings, 0) AS cancelled_bookings,
               coalesce(failed_payments, 0) AS failed_payments,
               {rate("failed_payments", "total_payments")} AS payment_fail_rate,
               coalesce(total_revenue, 0) AS total_revenue,
               coalesce(avg_review_rating, 0) AS avg_review_rating,
               coalesce(review_count, 0) AS review_count
        FROM located AS l JOIN hosts AS o USING (host_id) JOIN traffic USING (property_id)
        LEFT JOIN booking_stats USING (property_id) LEFT JOIN payment_stats USING (property_id)
        LEFT JOIN review_stats USING (property_id)
        WHERE views > 0""",
    "property_performance": f"""
        SELECT property_id, title AS property_name, property_type, base_price, city, host_name,
               host_rating, host_verified, views, unique_viewers, initiated_bookings,
               confirmed_bookings, completed_bookings, cancelled_bookings,
               {rate("initiated_bookings", "views")} AS initiation_rate,
               {rate("confirmed_bookings", "views")} AS confirmation_rate,
               {rate("completed_bookings", "views")} AS completion_rate,
               {rate("cancelled_bookings", "initiated_bookings")} AS cancel_rate,
               failed_payments, payment_fail_rate, total_revenue, avg_review_rating, review_count,
               CASE WHEN confirmed_bookings * 100.0 / views < 5 OR payment_fail_rate > 15 THEN 'intervention'
                    WHEN confirmed_bookings * 100.0 / views <= 10 THEN 'at_risk' ELSE 'promote'
               END AS performance_category
        FROM performance_counts""",
    "property_conversion": f"""
        SELECT l.property_id, city, property_type,
               {rate("initiated_bookings", "unique_viewers", 5, "NULL")} AS initiation,
               {rate("confirmed_bookings", "unique_viewers", 5, "NULL")} AS confirmation,
               {rate("completed_bookings", "unique_viewers", 5, "NULL")} AS completion
        FROM located AS l LEFT JOIN traffic USING (property_id) LEFT JOIN booking_stats USING (property_id)""",
    "amenity_means": """
        SELECT a.amenity_id, a.name AS amenity_name, a.category AS amenity_category, c.city, c.property_type,
               avg(initiation) FILTER (WHERE own.property_id IS NOT NULL) AS i1,
               avg(initiation) FILTER (WHERE own.property_id IS NULL) AS i0,
               avg(confirmation) FILTER (WHERE own.property_id IS NOT NULL) AS c1,
               avg(confirmation) FILTER (WHERE own.property_id IS NULL) AS c0,
               avg(completion) FILTER (WHERE own.property_id IS NOT NULL) AS d1,
               avg(completion) FILTER (WHERE own.property_id IS NULL) AS d0,
               count(DISTINCT c.property_id) FILTER (WHERE own.property_id IS NOT NULL) AS properties_with,
               count(DISTINCT c.property_id) FILTER (WHERE own.property_id IS NULL) AS properties_without
        FROM property_conversion AS c CROSS JOIN amenities AS a
        LEFT JOIN property_amenities AS own
               ON own.property_id = c.property_id AND own.amenity_id = a.amenity_id
        WHERE (initiation IS NOT NULL OR confirmation IS NOT NULL OR completion IS NOT NULL)
        GROUP BY ALL""",
    "amenity_lift": """
        SELECT amenity_id, amenity_name, amenity_category, city, property_type,
               coalesce(i1, 0) AS avg_initiation_with, coalesce(i0, 0) AS avg_initiation_without,
               coalesce(i1, 0) - coalesce(i0, 0) AS initiation_lift,
               coalesce(c1, 0) AS avg_confirmation_with, coalesce(c0, 0) AS avg_confirmation_without,
               coalesce(c1, 0) - coalesce(c0, 0) AS confirmation_lift,
               coalesce(d1, 0) AS avg_completion_with, coalesce(d0, 0) AS avg_completion_without,
               coalesce(d1, 0) - coalesce(d0, 0) AS completion_lift,
               properties_with, properties_without,
               CASE WHEN round(coalesce(c1, 0) - coalesce(c0, 0), 10) >= 8 THEN 'must_have'
                    WHEN round(coalesce(c1, 0) - coalesce(c0, 0), 10) >= 4 THEN 'differentiator'
                    ELSE 'low_impact' END AS impact_tier
        FROM amenity_means WHERE properties_with > 0 AND properties_without > 0""",
    "amenity_ranks": """
        SELECT city, property_type, amenity_name, confirmation_lift,
               row_number() OVER (PARTITION BY city, property_type
                                  ORDER BY CAST(round(confirmation_lift, 10) AS DECIMAL(18, 10)) DESC, amenity_id) AS rank
        FROM amenity_lift""",
    "attributed": """
        SELECT w.booking_id, w.user_id, w.city, w.booking_created_at, w.booking_status, w.check_out,
               w.payment_status, s.device, s.timestamp
        FROM window_bookings AS w JOIN silver_clicks AS s
          ON s.user_id = w.user_id AND s.device IS NOT NULL
         AND s.timestamp BETWEEN w.booking_created_at - INTERVAL 24 HOUR AND w.booking_created_at
        QUALIFY row_number() OVER (PARTITION BY w.booking_id
                                   ORDER BY s.timestamp DESC, s.device, w.payment_status NULLS LAST) = 1""",
    "device_funnel": f"""
        SELECT city, device, week_start, coalesce(viewers, 0) AS viewers,
               coalesce(initiated_bookers, 0) AS initiated_bookers,
               coalesce(confirmed_bookers, 0) AS confirmed_bookers, coalesce(completers, 0) AS completers,
               {rate("initiated_bookers", "viewers")} AS initiation_rate,
               {rate("confirmed_bookers", "viewers")} AS confirmation_rate,
               {rate("completers", "viewers")} AS completion_rate
        FROM (
            SELECT city, device, CAST(date_trunc('week', event_date) AS DATE) AS week_start,
                   count(DISTINCT user_id) AS viewers
            FROM silver_clicks JOIN located USING (property_id)
            WHERE event IN ('view', 'click') AND device IS NOT NULL GROUP BY ALL) AS seen
        FULL JOIN (
            SELECT city, device, CAST(date_trunc('week', booking_created_at) AS DATE) AS week_start,
                   count(DISTINCT user_id) AS initiated_bookers,
                   count(DISTINCT user_id) FILTER (WHERE {CONFIRMED}) AS confirmed_bookers,
                   count(DISTINCT user_id) FILTER (WHERE {COMPLETED}) AS completers
            FROM attributed GROUP BY ALL) AS booked USING (city, device, week_start)""",
    "device_diagnosis": """
        SELECT city, desktop_rate, mobile_rate, tablet_rate, device_gap_pct,
               CASE WHEN device_gap_pct > 25 THEN 'likely_ux_issue'
                    ELSE 'likely_supply_pricing_issue' END AS diagnosis,
               CASE WHEN last_rate > first_rate THEN 'improving' WHEN last_rate < first_rate THEN 'declining'
                    ELSE 'stable' END AS mobile_trend
        FROM (
            SELECT *, CASE WHEN desktop_rate > 0
                           THEN (desktop_rate - mobile_rate) * 100.0 / desktop_rate ELSE 0 END AS device_gap_pct
            FROM (
                SELECT city, coalesce(avg(confirmation_rate) FILTER (WHERE device = 'desktop'), 0) AS desktop_rate,
                       coalesce(avg(confirmation_rate) FILTER (WHERE device = 'mobile'), 0) AS mobile_rate,
                       coalesce(avg(confirmation_rate) FILTER (WHERE device = 'tablet'), 0) AS tablet_rate
                FROM device_funnel GROUP BY city)
            LEFT JOIN (
                SELECT DISTINCT city,
                       first_value(confirmation_rate) OVER weeks AS first_rate,
                       last_value(confirmation_rate) OVER weeks AS last_rate
                FROM device_funnel WHERE device = 'mobile'
                WINDOW weeks AS (PARTITION BY city ORDER BY week_start
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) USING (city))""",
    # --- generated traffic ------------------------------------------------------------
    "event_windows": """
        SELECT place * 10 + n AS event_seq, nearest, farthest
        FROM (VALUES (0, 604800, 2419200, 3), (1, 604800, 2419200, 3), (2, 604800, 1814400, 2),
                     (3, 86400, 604800, 2), (4, 86400, 604800, 2), (5, 172800, 432000, 1),
                     (6, 60, 3600, 1), (7, 60, 3600, 1), (8, 10, 300, 1)) AS w(place, nearest, farthest, events),
             range(3) AS r(n)
        WHERE n < events""",
    "booking_views": f"""
        SELECT user_id, property_id, 'view' AS event,
               make_timestamp((epoch_us(created_at) // 1000000 - nearest
                   - {scaled(0, "farthest - nearest", "booking_id", "event_seq")}) * 1000000) AS timestamp,
               {chained_device(1, "booking_id", "event_seq")} AS device,
               {chained_referrer(3, "booking_id", "event_seq")} AS referrer
        FROM bookings CROSS JOIN event_windows""",
    "ranged_views": """
        SELECT * FROM booking_views
        WHERE timestamp >= (SELECT min(created_at) FROM bookings)
          AND timestamp < (SELECT max(created_at) - INTERVAL 10 SECOND FROM bookings)""",
    "sampled_pairs": f"""
        SELECT user_id, property_id FROM (SELECT DISTINCT user_id, property_id FROM bookings)
        ORDER BY {draw(6, "user_id", "property_id")}, {draw(18, "user_id", "property_id")}, user_id, property_id
        LIMIT 50""",
    "prelaunch_views": f"""
        SELECT user_id, property_id, 'view' AS event,
               make_timestamp(((SELECT epoch_us(min(created_at)) // 1000000 FROM bookings) - 604800
                   + {scaled(12, 604800, "user_id", "property_id", "n")}) * 1000000) AS timestamp,
               {chained_device(7, "user_id", "property_id")} AS device,
               {chained_referrer(9, "user_id", "property_id")} AS referrer
        FROM sampled_pairs CROSS JOIN range(10) AS r(n)""",
    "indexed_properties": """
        SELECT property_id, row_number() OVER (ORDER BY property_id % 1009, property_id) - 1 AS place
        FROM (SELECT DISTINCT property_id FROM bookings)""",
    "browse_floor": """
        SELECT coalesce(greatest(max(user_id) + 1, 200000), 200000) AS floor FROM bookings""",
    "browse_users": """
        SELECT u AS user_id
        FROM range((SELECT floor FROM browse_floor), (SELECT floor FROM browse_floor) + (SELECT CAST(floor(count(DISTINCT user_id) / 0.44) AS BIGINT)
                                            - count(DISTINCT user_id) FROM bookings)) AS r(u)""",
    "browse_views": f"""
        SELECT v.user_id, property_id, 'view' AS event, v.timestamp, v.device, v.referrer
        FROM (
            SELECT user_id, {scaled(14, "(SELECT count(*) FROM indexed_properties)", "user_id", "n")} AS place,
                   TIMESTAMP '2022-12-01' + to_seconds({scaled(15, 83_980_800, "user_id", "n")}) AS timestamp,
                   {choose(16, [("mobile", .5), ("desktop", .3), ("tablet", .2)], "user_id", "n")} AS device,
                   {choose(17, [("google", .4), ("direct", .25), ("ad", .2), ("email", .15)], "user_id", "n")}
                       AS referrer
            FROM browse_users CROSS JOIN range(6) AS r(n)
            WHERE n <= {draw(13, "user_id")} % 6) AS v
        JOIN indexed_properties USING (place)""",
    "synthetic": """
        SELECT * FROM ranged_views UNION ALL SELECT * FROM prelaunch_views UNION ALL SELECT * FROM browse_views""",
    # --- serving ----------------------------------------------------------------------
    "user_snapshot": """
        SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "user_latest": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
}


def with_parts(body: str) -> str:
    """The query with every part it refers to, directly or through others, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(PARTS[name])

    visit(body)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed)
    return f"WITH {parts}\n{body}" if parts else body
