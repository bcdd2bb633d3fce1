"""Edge cases of the datasets on hand-written tables."""

from datetime import date
from decimal import Decimal

import pytest
from market_rows import at, booking, event, payment, rows

from innmetrics import Config
from innmetrics.plans import performance, segments
from innmetrics.plans.amenity import amenity_city_top
from innmetrics.plans.pipeline import quality_report, refresh
from innmetrics.session import work_folder

# ------------------------------------------------------------------------------- silver


def test_clickstream_drops_null_and_unknown_events_and_null_users(market):
    m = market(
        clickstream=[event(1, 1), event(1, 1, "hover"), event(1, 1, None), event(None, 1), event(2, None, "search")]
    )
    assert rows(m.silver_clickstream, "user_id", "event") == [(1, "view"), (2, "search")]


def test_booking_has_one_row_per_payment_and_one_without(market):
    m = market(
        bookings=[booking(1, 1, 1), booking(2, 1, 1), booking(3, 1, None), booking(4, 1, 99)],
        payments=[payment(10, 1, "failed"), payment(11, 1, "completed"), payment(12, 77)],
    )
    found = rows(m.silver_bookings_enriched, "booking_id", "payment_status", "city", "host_name")
    assert found == [
        (1, "completed", "Porto", "Ada"),
        (1, "failed", "Porto", "Ada"),
        (2, None, "Porto", "Ada"),
    ]


def test_null_booking_id_fails_the_run(market):
    m = market(bookings=[booking(None, 1, 1)])
    with pytest.raises(Exception, match="required_booking_id"):
        m.silver_bookings_enriched.collect()


# ------------------------------------------------------------------------- city funnel


def test_city_funnel_stages_and_one_sided_days(market):
    m = market(
        clickstream=[
            event(1, 2, when=at(9)),
            event(1, 2, when=at(9, 14)),
            event(2, 2, "click", at(9)),
            event(3, 1, "search", at(11)),
            event(4, None, "filter", at(11)),
            event(5, 99, "view", at(11)),
        ],
        bookings=[
            booking(1, 1, 2, "completed", when=at(10), out=19),
            booking(2, 1, 2, "completed", when=at(10), out=20),
            booking(3, 2, 2, "confirmed", when=at(10)),
            booking(4, 3, 2, "cancelled", when=at(10)),
            booking(5, None, 2, "confirmed", when=at(10)),
            booking(6, 9, 2, "completed", when=at(12)),
        ],
        payments=[payment(10, 1), payment(11, 2), payment(12, 3)],
    )
    found = rows(m.city_funnel)
    assert found == [
        ("Bergen", date(2024, 1, 9), 1, 1, 0, 0, 0, 0, 0),
        ("Bergen", date(2024, 1, 10), 0, 0, 0, 0, 3, 2, 1),
        ("Porto", date(2024, 1, 11), 0, 0, 1, 0, 0, 0, 0),
    ]


def test_check_out_today_is_not_completed(market):
    m = market(
        clickstream=[event(1, 2)], bookings=[booking(1, 1, 2, out=20)], payments=[payment(10, 1)]
    )
    assert [r.completers for r in m.city_funnel.collect()] == [0]


def test_empty_clickstream_means_no_bookings(market):
    m = market(bookings=[booking(1, 1, 2)], payments=[payment(10, 1)])
    assert m.date_boundaries.first().min_date is None
    for frame in (m.city_funnel, m.device_funnel, m.property_performance, m.amenity_lift, m.device_diagnosis):
        assert frame.count() == 0


# ---------------------------------------------------------------------- city investment


def test_investment_quadrants_count_the_median_as_high(spark, market):
    m = market(bookings=[booking(1, 1, 1, "confirmed", "30.00"), booking(2, 1, 1, "confirmed", "60.00")],
               payments=[payment(10, 1), payment(11, 1)])
    funnel = spark.createDataFrame(
        [("A", 10, 1), ("A", 10, 0), ("B", 20, 0), ("C", 4, 2), ("D", 30, 9), ("E", 0, 0)],
        "city string, viewers long, completers long",
    )
    found = segments.city_investment(funnel, m.silver_bookings_enriched).collect()
    quadrants = {r.city: r.quadrant for r in found}
    assert quadrants == {
        "A": "Protect & Expand",
        "B": "Fix Supply/UX",
        "C": "Invest Marketing",
        "D": "Protect & Expand",
        "E": "Deprioritize",
    }
    revenue = {r.city: r.estimated_revenue for r in found}
    assert revenue["D"] == pytest.approx(9 * (30 + 30 + 60) / 3)  # two payment rows count twice


# ----------------------------------------------------------------- property performance


def _viewed(users, stay, per_user=1):
    return [event(u, stay, when=at(10, 1 + n)) for u in users for n in range(per_user)]


def test_performance_category_limits(market):
    clicks, booked = [], []
    for stay, confirmed in ((1, 4), (2, 5), (3, 10), (4, 11)):
        clicks += _viewed(range(100), stay)
        booked += [booking(1000 * stay + n, n, stay, "confirmed") for n in range(confirmed)]
    m = market(clickstream=clicks, bookings=booked)
    found = {r.property_id: r.performance_category for r in m.property_performance.collect()}
    assert found == {1: "intervention", 2: "at_risk", 3: "at_risk", 4: "promote"}


@pytest.mark.parametrize("failed, category", [(3, "promote"), (4, "intervention")])
def test_payment_failure_limit(market, failed, category):
    m = market(
        clickstream=_viewed(range(20), 1),
        bookings=[booking(n, n, 1, "confirmed") for n in range(20)],
        payments=[payment(100 + n, n, "failed" if n < failed else "completed") for n in range(20)],
    )
    row = m.property_performance.first()
    assert (float(row.payment_fail_rate), row.performance_category) == (failed * 5.0, category)


def test_revenue_weighs_touches_and_payments_and_clean_revenue_does_not(market):
    m = market(
        clickstream=_viewed([1], 1, per_user=3) + [event(2, 1, "search")],
        bookings=[
            booking(1, 1, 1, "confirmed", "10.00"),
            booking(2, 1, 1, "confirmed", "7.00"),
            booking(3, 1, 1, "completed", "5.00"),
            booking(4, 2, 1, "confirmed", "99.00"),
        ],
        payments=[payment(10, 1, "failed"), payment(11, 1), payment(12, 3)],
    )
    row = m.property_performance.first()
    assert row.total_revenue == Decimal("10.00") * 2 * 3 + Decimal("7.00") * 3
    assert (row.views, row.unique_viewers, row.initiated_bookings, row.completed_bookings) == (3, 1, 3, 1)
    assert (row.failed_payments, float(row.payment_fail_rate)) == (1, pytest.approx(100 / 3))
    pairs = performance.viewer_pairs(m.silver_clickstream)
    facts = performance.booking_facts(m.tables, pairs, m.date_boundaries, m.config.today())
    assert rows(performance.property_revenue_clean(facts)) == [(1, Decimal("17.00"), 2)]


def test_reviews_skip_deleted_and_unknown(market):
    m = market(
        clickstream=_viewed([1], 1) + _viewed([1], 2),
        reviews=[(1, 4.0, False), (1, 2.0, False), (1, 5.0, True), (1, 5.0, None)],
    )
    found = rows(m.property_performance, "property_id", "avg_review_rating", "review_count")
    assert found == [(1, 3.0, 2), (2, 0.0, 0)]


# ------------------------------------------------------------------------- amenity lift

_AMENITIES = [(7, "pool", "fun"), (8, "sauna", "fun"), (9, "wifi", "work")]


def _lift_market(market, confirmed, viewers=25, bridge=((7, 1),), **extra):
    """Properties 1, 3, 5, ... (all in Porto) with the given confirmed bookings each."""
    clicks, booked = [], []
    for place, count in enumerate(confirmed):
        stay = 1 + 2 * place
        clicks += _viewed(range(viewers), stay)
        booked += [booking(1000 * stay + n, n, stay, "confirmed") for n in range(count)]
    return market(
        clickstream=clicks,
        bookings=booked,
        amenities=_AMENITIES,
        property_amenities=[(stay, amenity) for amenity, stay in bridge],
        **extra,
    )


@pytest.mark.parametrize("more, tier", [(2, "must_have"), (1, "differentiator"), (0, "low_impact")])
def test_lift_tiers_at_their_limits(market, more, tier):
    m = _lift_market(market, [3 + more, 3])
    row = m.amenity_lift.first()
    assert (float(row.confirmation_lift), row.impact_tier) == (4.0 * more, tier)
    assert (row.properties_with, row.properties_without) == (1, 1)


def test_amenity_of_all_or_no_properties_is_left_out(market):
    m = _lift_market(market, [5, 3], bridge=[(7, 1), (7, 3), (8, 1)])
    assert rows(m.amenity_lift, "amenity_name") == [("sauna",)]


def test_repeated_bridge_rows_weigh_the_mean_but_not_the_count(market):
    m = _lift_market(market, [5, 1, 3], bridge=[(7, 1), (7, 1), (7, 3)])
    row = m.amenity_lift.first()
    assert float(row.avg_confirmation_with) == pytest.approx((20 + 20 + 4) / 3)
    assert float(row.avg_confirmation_without) == 12.0
    assert (row.properties_with, row.properties_without) == (2, 1)


@pytest.mark.parametrize("viewers, groups", [(5, 0), (6, 1)])
def test_lift_needs_more_than_five_viewers(market, viewers, groups):
    assert _lift_market(market, [1, 0], viewers=viewers).amenity_lift.count() == groups


def test_bookings_of_a_property_without_host_do_not_lift(market):
    properties = [(1, "a", "house", 1.0, 1, 1), (3, "b", "house", 1.0, 1, 404)]
    m = _lift_market(market, [1, 5], properties=properties)
    row = m.amenity_lift.first()
    assert (float(row.avg_confirmation_with), float(row.avg_confirmation_without)) == (4.0, 0.0)


def test_top_amenities_break_ties_by_id(spark):
    lift = spark.createDataFrame(
        [(n, f"amenity {n}", "Porto", "house", Decimal(v)) for n, v in ((4, "1"), (3, "1"), (2, "1"), (1, "0.5"), (5, "2"))],
        "amenity_id long, amenity_name string, city string, property_type string, confirmation_lift decimal(38,14)",
    )
    top = amenity_city_top(lift, Config())
    assert [(r["rank"], r.amenity_name) for r in top.orderBy("rank").collect()] == [
        (1, "amenity 5"),
        (2, "amenity 2"),
        (3, "amenity 3"),
    ]


# ------------------------------------------------------------------------------ devices


def test_last_touch_limits_ties_and_payments(market):
    booked = at(10, 12, 0, 30)
    m = market(
        clickstream=[
            event(1, 5, when=at(9, 12, 0, 30), device="desktop"),  # exactly 24 hours before
            event(2, 5, when=booked, device="tablet"),  # at the booking itself
            event(3, 5, when=at(9, 12, 0, 29, 999_999), device="desktop"),  # too old
            event(3, 5, when=at(10, 12, 0, 31), device="desktop"),  # too late
            event(4, 5, "search", at(10, 11), device="tablet"),
            event(4, 5, "filter", at(10, 11), device="mobile"),  # same time, smaller name
            event(5, None, when=at(10, 11), device="mobile"),  # any property counts
            event(5, 5, when=at(10, 11, 30), device=None),
            event(6, 5, when=at(9, 23, 59), device="mobile"),  # previous day
        ],
        bookings=[booking(n, n, 1, when=booked) for n in range(1, 7)],
        payments=[payment(40, 4, "failed"), payment(41, 4, "completed")],
    )
    funnel = rows(m.device_funnel.where("initiated_bookers > 0"), "device", "initiated_bookers", "completers")
    assert funnel == [("desktop", 1, 0), ("mobile", 3, 1), ("tablet", 1, 0)]


def test_device_rates_are_zero_without_viewers(market):
    m = market(
        clickstream=[event(1, None, "search")], bookings=[booking(1, 1, 1, "confirmed")]
    )
    row = m.device_funnel.first()
    assert (row.viewers, row.initiated_bookers, float(row.initiation_rate)) == (0, 1, 0.0)


def test_diagnosis_without_mobile_or_desktop(spark):
    funnel = spark.createDataFrame(
        [
            ("A", "desktop", date(2024, 1, 1), Decimal("8")),
            ("B", "mobile", date(2024, 1, 1), Decimal("2")),
            ("B", "mobile", date(2024, 1, 8), Decimal("9")),
            ("B", "mobile", date(2024, 1, 15), Decimal("3")),
            ("C", "desktop", date(2024, 1, 1), Decimal("4")),
            ("C", "mobile", date(2024, 1, 1), Decimal("3")),
            ("D", "desktop", date(2024, 1, 1), Decimal("4")),
            ("D", "mobile", date(2024, 1, 1), Decimal("2.9")),
            ("D", "mobile", date(2024, 1, 8), Decimal("2.8")),
        ],
        "city string, device string, week_start date, confirmation_rate decimal(38,14)",
    )
    found = rows(segments.device_diagnosis(funnel, Config()), "city", "device_gap_pct", "diagnosis", "mobile_trend")
    assert [(c, float(g), d, t) for c, g, d, t in found] == [
        ("A", 100.0, "likely_ux_issue", "stable"),
        ("B", 0.0, "likely_supply_pricing_issue", "improving"),
        ("C", 25.0, "likely_supply_pricing_issue", "stable"),
        ("D", 28.75, "likely_ux_issue", "declining"),
    ]


# ------------------------------------------------------------------------------ quality


def _report(spark, market):
    return quality_report(spark, refresh(market, work_folder(spark, "test"))[1]).collect()


def test_report_counts_null_predicates_as_failed(market, spark):
    m = market(clickstream=[event(1, 1), event(1, 1, None), event(None, 1)])
    found = {(r.dataset, r.constraint): (r.action, r.passed, r.failed) for r in _report(spark, m)}
    assert len(found) == 15
    assert found["silver_clickstream", "valid_event"] == ("drop", 2, 1)
    assert found["silver_clickstream", "valid_user_id"] == ("drop", 2, 1)


def test_warning_fires_when_bookings_exceed_views(market, spark):
    m = market(clickstream=_viewed([1], 1), bookings=[booking(n, 1, 1, "confirmed") for n in range(3)])
    found = {(r.dataset, r.constraint): r.failed for r in _report(spark, m)}
    assert found["property_performance", "valid_initiation_rate"] == 1
    assert found["property_performance", "logical_funnel"] == 0
