"""Day state of the city funnel, and the sets it consists of."""

import random
from datetime import date
from pathlib import Path

import pytest
from market_rows import at, booking, event, payment, rows
from pyspark.sql import functions as F

from innmetrics.operators.bitsets import count_bits, member_bits, merge_bits
from innmetrics.operators.distinct import count_members
from innmetrics.plans import daily, funnels
from innmetrics.plans.pipeline import Marketplace, refresh
from innmetrics.session import work_folder

USERS = [*range(200), *range(-70, 0), *[i * 2**20 for i in range(300)], 2**63 - 1, -(2**63), 63, 64, None]


def test_sets_count_as_distinct_does(spark):
    """Dense ids and ids that each fall on a word of their own."""
    rng = random.Random(3)
    data = [(rng.choice("xxxy"), rng.randrange(9), rng.choice(USERS), rng.random() < 0.3, rng.choice([True, None])) for _ in range(4000)]
    data.append(("only null", 1, None, True, True))
    frame = spark.createDataFrame(data, "g string, day int, u long, a boolean, b boolean")
    flags = {"a": F.col("a"), "b": F.col("b"), "all": F.lit(True)}
    days = member_bits(frame, ["g", "day"], "u", flags)
    for group in (["g", "day"], ["g"], ["day"], []):
        assert rows(count_bits(days, group, list(flags))) == rows(count_members(frame, group, "u", flags))
    halves = [member_bits(frame.where(F.col("day") % 2 == n), ["g"], "u", flags) for n in (0, 1)]
    merged = merge_bits(halves[0].unionByName(halves[1]), ["g"], list(flags))
    assert rows(count_bits(merged, ["g"], list(flags))) == rows(count_members(frame, ["g"], "u", flags))


@pytest.fixture
def store(spark, market):
    """A market whose clean events are stored by date, in one drop after another."""
    root = work_folder(spark, "days")

    class Store:
        path, state = f"{root}/clicks", f"{root}/state"

        def drop(self, *events):
            clicks = market(clickstream=list(events)).silver_clickstream
            clicks.write.mode("append").partitionBy("event_date").parquet(self.path)

        def clicks(self):
            schema = market().silver_clickstream.schema
            return spark.read.schema(schema).parquet(self.path).select(*schema.names)

        def refresh(self, m, place=None):
            state = place or self.state
            days = daily.update_state(self.clicks(), m.tables, state)
            return [d.day for d in days], rows(daily.city_funnel_of_state(state, m.silver_bookings_enriched, m.config))

    return Store()


def test_two_drops_equal_a_full_rebuild_and_leave_old_days_unread(spark, market, store):
    bookings = [booking(1, 1, 1, when=at(10)), booking(2, 2, 2, "confirmed", when=at(12)), booking(3, 3, 1, when=at(14))]
    m = market(bookings=bookings[:1], payments=[payment(1, 1)])
    store.drop(event(1, 1, when=at(10)), event(2, 1, "click", at(11)), event(2, 2, when=at(11)), event(5, 999, when=at(9)))
    assert store.refresh(m)[0] == [9, 10, 11]
    assert store.refresh(m)[0] == []
    for file in Path(store.path).glob("event_date=2024-01-10/*.parquet"):
        file.write_bytes(b"not parquet any more")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    m = market(bookings=bookings, payments=[payment(1, 1), payment(2, 2)])  # bookings change in place
    store.drop(event(7, 2, when=at(11)), event(1, 2, "search", at(14)))
    days, found = store.refresh(m)
    assert days == [11, 14]
    whole = market(
        clickstream=[event(1, 1, when=at(10)), event(2, 1, "click", at(11)), event(2, 2, when=at(11)), event(5, 999, when=at(9)),
                     event(7, 2, when=at(11)), event(1, 2, "search", at(14))],
        bookings=bookings, payments=[payment(1, 1), payment(2, 2)],
    )
    assert found == rows(whole.city_funnel)
    assert ("Porto", date(2024, 1, 14), 0, 0, 0, 0, 1, 1, 0) in found


def test_a_moved_property_and_a_day_gone(spark, market, store):
    m = market()
    store.drop(event(1, 1, when=at(10)), event(2, 1, when=at(11)))
    store.refresh(m)
    moved = market(properties=[(n, f"stay {n}", "house", 50.0, 0, 1) for n in range(1, 40)])
    days, found = store.refresh(moved)
    assert days == [10, 11] and {r[0] for r in found} == {"Bergen"}
    nowhere = market(properties=[])
    assert store.refresh(nowhere) == ([10, 11], [])
    assert store.refresh(nowhere) == ([], [])
    store.refresh(moved)
    for file in Path(store.path).glob("event_date=2024-01-10/*"):
        file.unlink()
    Path(f"{store.path}/event_date=2024-01-10").rmdir()
    assert store.refresh(moved) == ([], [("Bergen", date(2024, 1, 11), 1, 0, 0, 0, 0, 0, 0)])


def test_weeks_count_a_user_once(market, store):
    m = market()
    store.drop(event(1, 1, when=at(8)), event(1, 1, when=at(9)), event(2, 1, when=at(10)), event(1, 1, when=at(15)))
    store.refresh(m)
    week = F.date_trunc("week", "event_date").cast("date")
    weekly = daily.city_funnel_of_state(store.state, m.silver_bookings_enriched, m.config, week)
    assert rows(weekly, "event_date", "viewers") == [(date(2024, 1, 8), 2), (date(2024, 1, 15), 1)]


def test_refresh_takes_the_funnel_from_day_state(spark, market, store):
    m = market(bookings=[booking(1, 1, 1, when=at(10))])
    store.drop(event(1, 1, when=at(10)), event(2, 2, when=at(12)))
    root = work_folder(spark, "test")
    written, _ = refresh(Marketplace(m.tables, m.config), root, store.clicks(), days=f"{root}/days")
    full = funnels.city_funnel(m.tables, store.clicks(), m.silver_bookings_enriched, written["silver_clickstream"].agg(
        F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date")), m.config)
    assert rows(written["city_funnel"]) == rows(full) != []
    assert daily.read_days(spark, f"{root}/days").count() == 2
