"""Operators that compare texts with each other or with benchmark items."""

import random

import numpy as np
from helpers import ODD, PROSE, brute_components, brute_repeats, frame, rows_of
from pyspark.sql import functions as F

from innmetrics.llm import decontaminate, simhash, suffix_dedup
from innmetrics.llm.components import components


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000), (None, 3), (5, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    made = components(spark.createDataFrame(links, "a BIGINT, b BIGINT"))
    assert {(r.vertex, r.component) for r in made.collect()} == {(x, root(x)) for x in parent}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = rnd.choice(["alpha", "beta", "gamma"])
    return " ".join(words)


def test_simhash_equals_comparing_all(spark):
    rnd = random.Random(8)
    docs = list(ODD)
    for base in range(25):
        words = ["".join(rnd.choices("abcdefg", k=4)) for _ in range(rnd.randint(3, 400))]
        docs += [(100 * base + 1000 + i, edited(rnd, words, rnd.randint(0, 2))) for i in range(6)]
    made = simhash.near_duplicates(frame(spark, docs)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"
    )
    assert rows_of(made) == brute_components(docs)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_close_pairs_are_complete(spark):
    """Pigeonring loses no pair within the limit and lets no other through."""
    rnd = random.Random(6)
    values = {rnd.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for flips in (1, 2, 3, 4, 4, 4, 5, 6):
            for bit in rnd.sample(range(64), flips):
                v ^= 1 << bit
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    array = np.array(signed, np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array) <= 4
    expected = {(signed[i], signed[j]) for i in range(len(signed)) for j in range(i + 1, len(signed)) if near[i, j]}
    made = [tuple(r) for r in simhash.close_pairs(spark.createDataFrame([(v,) for v in signed], "fp BIGINT")).collect()]
    assert len(made) == len(set(made)) and set(made) == expected


def test_repeats_equal_comparing_all(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choices("ab cé", k=rnd.randint(30, 300))) for _ in range(20)]
    docs = [(i, t) for i, t in ODD if i != 8]
    for i in range(100, 220):
        parts = [rnd.choice(base), rnd.choice(base)[rnd.randint(0, 20) :], "a" * rnd.randint(0, 120)]
        docs.append((i, "".join(rnd.choices(parts, k=rnd.randint(0, 4)))))
    docs += [(100, docs[-1][1]), (100, "zz"), (3, base[1]), (500, base[1]), (None, base[0]), (-5, base[2])]
    rnd.shuffle(docs)
    for hot in (suffix_dedup.HOT_TUPLES, 3):
        made = suffix_dedup.remove_repeats(frame(spark, docs), hot_tuples=hot).drop("kept")
        assert rows_of(made) == brute_repeats(docs)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_blocks_of_sorted_tuples_may_be_small(spark, monkeypatch):
    docs = [(i, PROSE[: 60 + i]) for i in range(30)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_TUPLES", 2)
    assert rows_of(suffix_dedup.remove_repeats(frame(spark, docs)).drop("kept")) == brute_repeats(docs)


def test_least_between():
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 50, 200)
    left = rnd.integers(0, 199, 500)
    right = left + 1 + rnd.integers(0, 200, 500) % (200 - left)
    assert suffix_dedup.least_between(values, left, right).tolist() == [
        values[a:b].min() for a, b in zip(left.tolist(), right.tolist())
    ]


def plain_smith_waterman(text, item):
    best, scores = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            hit = decontaminate.MATCH if item[i - 1] == text[j - 1] else decontaminate.MISMATCH
            scores[i][j] = max(
                0, scores[i - 1][j - 1] + hit, scores[i - 1][j] + decontaminate.GAP, scores[i][j - 1] + decontaminate.GAP
            )
            best = max(best, scores[i][j])
    return best


def test_smith_waterman():
    rnd = np.random.default_rng(2)
    texts = [rnd.integers(0, 5, rnd.integers(0, 40)) for _ in range(60)]
    items = [rnd.integers(0, 5, rnd.integers(1, 20)) for _ in range(60)]
    assert decontaminate.smith_waterman(texts, items).tolist() == [
        plain_smith_waterman(t.tolist(), i.tolist()) for t, i in zip(texts, items)
    ]


def test_leaks_are_found_and_others_left(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)] + [(90, "too short"), (91, None), (0, None)]
    items = items[:-1] + [items[0]]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, noise(100)) for i in range(40)]
    docs += [(100 + i, f"{noise(50)} {items[i][1].upper()}! {noise(50)}") for i in range(10)]
    changed = items[11][1].split()
    for at in (3, 11, 17, 25):
        changed[at] = "changed"
    docs += [(200, f"{noise(500)} {' '.join(changed[:14] + ['extra'] + changed[14:])} {noise(30)}")]
    docs += [(201, " ".join(items[12][1].split()[:8]) + " " + noise(40)), (202, None), (203, ""), (None, items[0][1])]
    docs += [(100, docs[40][1])] + [(300 + i, items[5][1]) for i in range(30)]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id BIGINT, text STRING, doc_id INT")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, docs), benchmark).collect()}
    assert found == {(100 + i, i) for i in range(10)} | {(200, 11)} | {(300 + i, 5) for i in range(30)}
    assert decontaminate.contaminated(frame(spark, []), benchmark).count() == 0
    assert decontaminate.contaminated(frame(spark, docs), benchmark.limit(0)).count() == 0


def test_leaks_are_found_beside_exact_copies(spark):
    """Exact copies of an item don't hide an edited one whose equal runs stand alone."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    changed = ["changed" if i % 5 == 4 else w for i, w in enumerate(words)]
    docs = [(i, " ".join(words)) for i in range(4)] + [(10, " ".join(changed))]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id BIGINT, text STRING")
    found = {r.doc_id for r in decontaminate.contaminated(frame(spark, docs), benchmark).collect()}
    assert found == {0, 1, 2, 3, 10}


def test_numbers_and_repeated_item_ids(spark):
    """Digits are words, and each text of an item_id is looked for."""
    items = [(1, "What is 12 + 45 * 3 = ?"), (1, "name the seven wizards who brew strong potions"), (2, "1 2 3")]
    docs = [(1, "so: what is 12 + 45 * 3 = ? it is 147"), (2, "Name the seven wizards who brew strong potions!"),
            (3, "what is 13 + 46 * 4"), (4, "1 2 3"), (5, "1 2 3 4 5")]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = {(r.doc_id, r.item_id, round(r.similarity, 3)) for r in decontaminate.contaminated(frame(spark, docs), benchmark).collect()}
    assert found == {(1, 1, 1.0), (2, 1, 1.0)}


def test_leaks_equal_aligning_every_text_with_every_item(spark):
    """Where four words in a row are shared, the result is that of all pairs."""
    rnd = random.Random(31)
    word = lambda: "".join(rnd.choices("abcdefgh12", k=3))
    items = [(i, " ".join(word() for _ in range(rnd.randint(6, 25)))) for i in range(12)]
    docs = []
    for i in range(60):
        words = items[rnd.randrange(12)][1].split()
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randrange(len(words))
            words[at : at + 1] = rnd.choice([[word()], [], [words[at], word()]])
        docs.append((i, " ".join([word() for _ in range(rnd.randint(0, 9))] + words + [word() for _ in range(rnd.randint(0, 9))])))
    expected = {}
    for i, text in docs:
        for j, item in items:
            x, y = text.split(), item.split()
            runs = {tuple(y[k : k + 4]) for k in range(len(y) - 3)}
            if any(tuple(x[k : k + 4]) in runs for k in range(len(x) - 3)):
                share = plain_smith_waterman(x, y) / (2 * len(y))
                if share >= decontaminate.MIN_SIMILARITY:
                    expected[i, j] = share
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(frame(spark, docs), benchmark).collect()}
    assert found == expected and len(found) > 30
