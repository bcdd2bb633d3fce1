"""Mixing by hash thresholds against a plain version, and against SQL on odd tables."""

import random
import re
from collections import Counter, defaultdict

import pytest
from compare import compare
from helpers import ODD, frame

from innmetrics.llm import mixing
from innmetrics.llm.queries import ORACLES, QUERIES

COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, hash INT, name STRING, target STRING"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shared by weight, what is above the limit is taken off and shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ones, left = {}, set(order), share * sum(sizes.values())
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_ones}
        target |= {s: most * sizes[s] for s in full}
        left, open_ones = left - sum(most * sizes[s] for s in full), open_ones - full
    return target


def tables(kind):
    rnd = random.Random(kind)
    word = lambda: "".join(rnd.choices("abc", k=3))
    text = lambda n: " ".join(word() for _ in range(n))
    if kind == "many":
        return [(i, text(rnd.randint(0, 60)), f"é{i % 7}" if i % 3 else "hot") for i in range(4000)]
    if kind == "uneven":
        small = [(i, text(rnd.randint(1, 5)), rnd.choice(["a", "b", None, ""])) for i in range(300)]
        return small + [(1000, text(20000), "c"), (1001, None, "d"), (1002, " \n", "e")]
    if kind == "repeated":
        same = [(7, "one two three", "a")] * 500 + [(None, "x y", "a")] * 300 + [(7, "one two three", None)] * 200
        return same + [(i, text(30), "b") for i in range(20)]
    return [(i, t, None if i == 5 else "s") for i, t in ODD] if kind == "odd" else []


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 1, "n", "t") for i, t, s in rows], COLUMNS)


@pytest.mark.parametrize("kind", ["many", "uneven", "repeated", "odd", "empty"])
def test_mix_is_near_its_targets(spark, kind):
    rows = tables(kind)
    made = mixing.mix(documents(spark, rows)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest, taken = Counter(), Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size, r.source_size) for r in made) == Counter(
        (i, s, size(t), sizes[s]) for i, t, s in rows
    )
    for r in made:
        assert r.target == pytest.approx(target[r.source]) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source] / 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


@pytest.mark.parametrize("kind", ["many", "uneven", "repeated", "odd"])
def test_mix_equals_sql(spark, kind, tmp_path):
    import duckdb

    documents(spark, tables(kind)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(QUERIES["op11_source_mixing"](spark, str(tmp_path)), con, ORACLES["op11_source_mixing"]) == []


def test_larger_budgets_take_all_that_smaller_ones_take(spark):
    docs = documents(spark, tables("many"))
    before = defaultdict(int)
    for share in (0.2, 0.7, 1.1, 1.9):
        now = {r.doc_id: r.copies for r in mixing.mix(docs, weights=(1,), share=share).collect()}
        assert all(now[i] >= before[i] for i in now)
        before = now


def test_rows_spread_otherwise_give_the_same_mix(spark):
    docs = documents(spark, tables("repeated"))
    one, other = (Counter(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert one == other


def test_odd_and_no_documents(spark):
    assert mixing.mix(frame(spark, ODD)).count() == len(ODD)
    assert mixing.mix(frame(spark, [])).count() == 0
