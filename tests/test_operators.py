"""Operators against brute force on random data with hot keys, copies and ties."""

import json
import math
import random
import re
from datetime import datetime, timedelta

import pytest
from market_rows import rows
from pyspark.sql import functions as F

from innmetrics.config import Config
from innmetrics.functions.draws import MODULUS, draw, scaled
from innmetrics.operators.dense_index import dense_index
from innmetrics.operators.distinct import count_distinct, count_members
from innmetrics.operators.last_touch import last_touch
from innmetrics.operators.prefix import count_before, count_within
from innmetrics.operators.quality import DROP, FAIL, Constraint, enforce, observed, report
from innmetrics.operators.ranking import top_per_key
from innmetrics.operators.share import count_shares
from innmetrics.operators.slots import slot
from innmetrics.plans import synth
from innmetrics.plans.monitoring import json_merge
from innmetrics.plans.scoring import batch_score, linear_score
from innmetrics.plans.spans import span_tree

START = datetime(2024, 1, 1)


def _moment(rng: random.Random) -> datetime:
    """Often on a slot or day edge, often repeated."""
    base = START + timedelta(minutes=rng.choice([0, 1, 719, 1439, 1440, 1441, 2880, rng.randrange(6000)]))
    return base + timedelta(microseconds=rng.choice([-1, 0, 0, 1, rng.randrange(60_000_000)]))


def _user(rng: random.Random):
    return rng.choice([7, 7, 7, 1, 2, 3, None])


@pytest.mark.parametrize("seed, hours", [(1, 24), (2, 24), (3, 5), (4, 30), (5, 1)])
def test_last_touch_equals_brute_force(spark, seed, hours):
    rng = random.Random(seed)
    touches = [(_user(rng), _moment(rng), rng.choice(["a", "b", "c", None])) for _ in range(400)]
    touches += [touches[0]] * 100
    moments = [(n, _user(rng), _moment(rng)) for n in range(150)]
    found = last_touch(
        spark.createDataFrame(moments, "id long, user long, moment timestamp"),
        spark.createDataFrame(touches, "user long, at timestamp, device string"),
        key="user",
        moment="moment",
        at="at",
        value="device",
        hours=hours,
    )
    expected = []
    for id, user, moment in moments:
        near = [
            (-at.timestamp(), device, at)
            for u, at, device in touches
            if u is not None and u == user and device and moment - timedelta(hours=hours) <= at <= moment
        ]
        if near:
            expected.append((id, min(near)[1], min(near)[2]))
    assert rows(found, "id", "device", "at") == sorted(expected, key=lambda r: tuple(str(v) for v in r))
    assert len(expected) > 15


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_count_before_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    hour = 3_600_000_000

    def time():
        return rng.choice([0, hour, hour - 1, -1, -hour, None, rng.randrange(50 * hour), rng.randrange(-9 * hour, 50 * hour)])

    events = [(_user(rng), rng.choice([5, 5, 6, None]), time()) for _ in range(500)]
    events += [events[3]] * 50
    probes = [(n, _user(rng), rng.choice([5, 6, None]), time()) for n in range(200)]
    found = count_before(
        spark.createDataFrame(probes, "id long, user long, stay long, bound long"),
        spark.createDataFrame(events, "user long, stay long, at long"),
        ["user", "stay"],
        bound="bound",
        at="at",
        counts={"all": F.lit(1), "odd": F.col("at") % 2},
    )
    same = lambda probe, event: None not in (*probe, *event) and tuple(probe[:2]) == event[:2]
    expected = []
    for id, *probe in probes:
        ever = [at for *key, at in events if same(probe, (*key, at))]
        earlier = [at for at in ever if at < probe[2]]
        odd = [sum(math.fmod(at, 2) for at in some) for some in (earlier, ever)]
        expected.append((id, len(earlier), odd[0], len(ever), odd[1]))
    columns = ("id", "all", "odd", "all_ever", "odd_ever")
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == expected


@pytest.mark.parametrize("seed, reach", [(1, 24), (2, 1), (3, 7)])
def test_count_within_equals_brute_force(spark, seed, reach):
    rng = random.Random(seed)
    hour = 3_600_000_000

    def time():
        return rng.choice([0, hour, hour * 24 - 1, -1, -24 * hour, None, rng.randrange(-30 * hour, 50 * hour)])

    events = [(_user(rng), time()) for _ in range(600)]
    events += [events[3]] * 50
    probes = [(n, _user(rng), time()) for n in range(200)]
    found = count_within(
        spark.createDataFrame(probes, "id long, user long, moment long"),
        spark.createDataFrame(events, "user long, at long"),
        ["user"], "moment", "at", reach * hour, ["id"],
    )
    expected = {
        id: sum(u == user and at is not None and moment - reach * hour <= at <= moment for u, at in events)
        for id, user, moment in probes
        if user is not None and moment is not None
    }
    assert {r.id: r.events for r in found.collect()} == expected and max(expected.values()) > 20


def test_span_tree(spark):
    """Three levels, an unknown parent, two traces with the same ids, cycles, a long chain."""
    spans = [("t", 1, None, 100), ("t", 2, 1, 60), ("t", 3, 2, 50), ("t", 4, 2, 5), ("t", 5, 99, 7)]
    spans += [("u", 1, 2, 1), ("u", 2, None, 10), ("u", 3, 3, 4)]  # 3 is its own parent
    spans += [("c", 1, 3, 1), ("c", 2, 1, 1), ("c", 3, 2, 1), ("c", 4, 3, 9), ("c", 5, None, 2), ("c", 6, 5, 1)]
    spans += [("long", n, n - 1 if n else None, 1) for n in range(200)]
    frame = spark.createDataFrame(spans, "trace string, id long, parent long, ms long")
    found = {(r.trace, r.id): (r.depth, r.path, r.own_time) for r in span_tree(frame, ["trace"], "id", "parent", "ms").collect()}
    assert len(found) == len(spans)
    assert [found["t", n] for n in (1, 2, 3, 4, 5)] == [
        (0, "1", 40), (1, "1/2", 5), (2, "1/2/3", 50), (2, "1/2/4", 5), (0, "5", 7)
    ]
    assert [found["u", n][:2] for n in (1, 2, 3)] == [(1, "2/1"), (0, "2"), (None, None)]
    assert [found["c", n][:2] for n in range(1, 7)] == [(None, None)] * 4 + [(0, "5"), (1, "5/6")]
    assert found["long", 199] == (199, "/".join(map(str, range(200))), 1)
    assert span_tree(frame.limit(0), ["trace"], "id", "parent", "ms").count() == 0


def test_json_merge_keeps_types(spark):
    texts = ['{"a": 1, "b": {"c": true}, "n": null, "big": 12345678901234567890, "f": 0.1}', '{"z": "1", "b": [1, {"x": "é"}]}',
             "{}", None, "[1]", "7", "broken {"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    merged = [r[0] for r in frame.select(json_merge("t", {"a": "1", "b": {"new": [True, None, 2.5]}})).collect()]
    assert [m and json.loads(m) for m in merged] == [
        {"a": "1", "b": {"new": [True, None, 2.5]}, "n": None, "big": 12345678901234567890, "f": 0.1},
        {"a": "1", "b": {"new": [True, None, 2.5]}, "z": "1"},
        {"a": "1", "b": {"new": [True, None, 2.5]}},
        None, None, None, None,
    ]


def test_slots_go_on_before_1970(spark):
    times = spark.createDataFrame([(t,) for t in (-21, -20, -1, 0, 9, 10, 2**62)], "t long")
    assert [r[0] for r in times.select(slot(F.col("t"), 10)).collect()] == [-3, -2, -1, 0, 0, 1, 2**62 // 10]


def test_a_key_with_most_rows_is_spread_by_time(spark):
    """No pairs, and no stage that brings the rows of one key together."""
    hot = spark.range(40_000).selectExpr("1L AS user", "timestamp_seconds(id * 60) AS at", "if(id % 2 = 0, 'a', 'b') AS device")
    moments = spark.range(2000).selectExpr("id", "1L AS user", "timestamp_seconds(id * 1200) AS moment")
    found = last_touch(moments, hot, "user", "moment", "at", "device")
    assert found.where("device = 'a' AND at = moment").count() == 2000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((\w+)", plan) and not re.findall(r"hashpartitioning\(user#\d+L, \d+\)", plan)


def test_count_members_equals_conditional_distinct_counts(spark):
    rng = random.Random(5)
    data = [(rng.choice("xxxy"), _user(rng), rng.random() < 0.3, rng.choice([True, None])) for _ in range(300)]
    frame = spark.createDataFrame(data, "g string, u long, a boolean, b boolean")
    found = rows(count_members(frame, ["g"], "u", {"a": F.col("a"), "b": F.col("b"), "all": F.lit(True)}))
    assert found == [
        (
            g,
            len({u for h, u, a, _ in data if h == g and a and u is not None}),
            len({u for h, u, _, b in data if h == g and b and u is not None}),
            len({u for h, u, *_ in data if h == g and u is not None}),
        )
        for g in "xy"
    ]


def test_top_per_key_limits_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = top_per_key(frame, ["k"], [F.col("id").desc()], count=2, rank="rank")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert rows(top) == [(0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)]


def test_dense_index_numbers_without_gaps(spark):
    ids = spark.range(0, 50_000, 7).union(spark.range(0, 50_000, 7)).withColumnRenamed("id", "p")
    found = dense_index(ids, "p").collect()
    assert sorted(r["index"] for r in found) == list(range(len(set(range(0, 50_000, 7)))))
    by_place = [r.p for r in sorted(found, key=lambda r: r["index"])]
    assert by_place == sorted(by_place, key=lambda p: (p % 1009, p))


def test_shares_add_up(spark):
    frame = spark.createDataFrame([("a",)] * 2 + [("b",)], "g string")
    assert [(g, n, float(p)) for g, n, p in rows(count_shares(frame, ["g"]))] == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert count_shares(frame.where("g = 'z'"), ["g"]).count() == 0


# ------------------------------------------------------------------------------ quality

_RULES = (Constraint("known", "x IS NOT NULL", DROP), Constraint("small", "x < 10"))


def test_enforce_drops_only_dropping_rules(spark):
    frame = spark.createDataFrame([(1,), (20,), (None,)], "x long")
    assert rows(enforce(frame, _RULES)) == [(1,), (20,)]
    assert rows(report(frame, "d", _RULES)) == [("d", "known", "drop", 2, 1), ("d", "small", "warn", 1, 2)]


def test_failing_rule_stops_the_write(spark, tmp_path):
    frame = spark.createDataFrame([(1,), (None,)], "x long")
    with pytest.raises(Exception, match="must_exist"):
        enforce(frame, [Constraint("must_exist", "x IS NOT NULL", FAIL)]).write.parquet(f"{tmp_path}/out")


def test_observed_counts_while_writing(spark):
    frame, seen = observed(spark.createDataFrame([(1,), (20,), (None,)], "x long"), _RULES, "t")
    frame.write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 3, "known": 1, "small": 2}


# -------------------------------------------------------------------------------- draws


def test_ids_a_modulus_apart_draw_differently(spark):
    far = spark.range(2000).select(
        draw(1, "id").alias("a"), draw(1, f"(id + {MODULUS}L)").alias("b"), draw(1, "(id + 1000003L)").alias("c")
    )
    assert far.where("a = b OR a = c").count() <= 2
    assert spark.range(3_000_000).select(draw(14, "id").alias("a")).distinct().count() > 2_990_000


def test_span_of_a_draw_is_checked(spark):
    assert spark.range(5).select(scaled(1, MODULUS, "id")).count() == 5
    with pytest.raises(Exception, match="too large"):
        spark.range(5).select(scaled(1, f"(id + {MODULUS + 1}L)", "id")).collect()


def test_browse_only_users_are_beyond_all_bookers(spark):
    bookings = spark.range(400_000, 400_100).selectExpr("id AS user_id", "id % 7 AS property_id")
    users = [r.user_id for r in synth.browse_only_events(bookings, Config()).select("user_id").distinct().collect()]
    assert len(users) == int(100 / 0.44) - 100
    assert min(users) == 400_100 and max(users) == 400_100 + len(users) - 1
    few = spark.range(3).selectExpr("id AS user_id", "id AS property_id")
    assert sorted(r.user_id for r in synth.browse_only_users(few, Config()).collect()) == [200_000, 200_001, 200_002]
    assert synth.browse_only_users(few.limit(0), Config()).count() == 0


@pytest.mark.parametrize("size", [10, 1000])
def test_a_bad_row_costs_no_other_its_score(spark, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    vectors = spark.range(500).selectExpr("id", "if(id = 77, NULL, array(1.0, cast(id AS double))) AS v")
    scored = batch_score(vectors, "id", "v", linear_score)
    assert [r.id for r in scored.where("error IS NOT NULL").collect()] == [77]
    assert scored.where("score IS NOT NULL").count() == 499
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equal_moments_give_equal_rows(spark):
    moments = spark.createDataFrame([(1, 1, datetime(2024, 1, 2))] * 2, "id long, user long, moment timestamp")
    touches = spark.createDataFrame([(1, datetime(2024, 1, 2), "m")] * 3, "user long, at timestamp, device string")
    assert last_touch(moments, touches, "user", "moment", "at", "device").count() == 2


def test_count_distinct(spark):
    frame = spark.createDataFrame([("x", 1, 2), ("x", 1, None), ("y", None, 3), (None, 4, 3)], "g string, a long, b long")
    found = count_distinct(frame, ["g"], {"da": "a", "db": "b"}, {"n": "*"}, {"most": ("max", "b")})
    assert rows(found) == [(None, 1, 1, 1, 3), ("x", 1, 1, 2, 2), ("y", 0, 1, 1, 3)]
    assert rows(count_distinct(frame.limit(0), [], {"da": "a"}, {"n": "*"})) == [(0, 0)]


def test_draws_are_uniform_and_streams_independent(spark):
    draws = spark.range(60_000).select(draw(1, "id").alias("a"), draw(2, "id").alias("b"))
    low = F.col("a") < MODULUS // 2
    stats = draws.agg(
        F.avg("a").alias("mean"),
        F.min("a").alias("least"),
        F.corr("a", "b").alias("corr"),
        F.avg(F.when(low, F.col("b"))).alias("b_where_low"),
    ).first()
    assert stats.mean == pytest.approx(MODULUS / 2, rel=0.02)
    assert stats.least >= 0
    assert abs(stats.corr) < 0.02
    assert stats.b_where_low == pytest.approx(MODULUS / 2, rel=0.03)


def test_generated_shares(spark):
    bookings = spark.range(20_000).selectExpr(
        "id AS booking_id", "id % 500 AS user_id", "id % 90 AS property_id",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 700 AS int)) AS created_at",
    )
    events = synth.booking_events(bookings)
    assert events.count() == 16 * 20_000

    def shares(part):
        return {r[0]: float(r.percentage) for r in count_shares(events.select(f"metadata.{part}"), [part]).collect()}

    assert shares("device") == pytest.approx({"mobile": 50, "desktop": 37.5, "tablet": 12.5}, abs=1)
    assert shares("referrer") == pytest.approx({"google": 40, "direct": 39, "ad": 17.85, "email": 3.15}, abs=1)


def test_offsets_stay_in_their_windows(spark):
    bookings = spark.range(3000).selectExpr(
        "id AS booking_id", "id AS user_id", "id AS property_id", "timestamp'2024-06-01' AS created_at"
    )
    lead = synth.booking_events(bookings).selectExpr(
        "unix_seconds(timestamp'2024-06-01') - unix_seconds(timestamp) AS lead"
    )
    assert lead.agg(F.min("lead"), F.max("lead")).first()[0] >= 10
    assert lead.agg(F.max("lead")).first()[0] < 28 * 86_400
    assert lead.where("lead < 300").count() >= 3000
