"""Learned operators: held-out accuracy, and odd inputs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from helpers import ODD, frame
from pyspark.sql import functions as F

from innmetrics.llm import language, quality_classifier
from innmetrics.llm.common import table
from innmetrics.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain_kneser_ney(words, order=language.ORDER):
    """Probability of a run's last character after the others, straight from the formula."""
    counts = {order: Counter()}
    for word in words:
        held = " " * (order - 1) + word + " "
        counts[order].update(held[i : i + order] for i in range(len(held) - order + 1))
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(run[1:] for run in counts[size + 1])
    discount, total, kinds = {}, defaultdict(Counter), defaultdict(Counter)
    for size, of in counts.items():
        ones, twos = (sum(n == k for n in of.values()) for k in (1, 2))
        discount[size] = ones / (ones + 2 * twos) if ones and twos else 0.5
        for run, n in of.items():
            total[size][run[:-1]] += n
            kinds[size][run[:-1]] += 1

    def p(run):
        size, context = len(run), run[:-1]
        lower = 1 / (kinds[1][""] + 1) if size == 1 else p(run[1:])
        own = (counts[size][run] - discount[size]) / total[size][context]
        return own + discount[size] * kinds[size][context] / total[size][context] * lower

    return {run: p(run) for of in counts.values() for run in of}


def test_probabilities_follow_the_formula(spark):
    words = "abba abab cab bad dab a bb acab dabba".split()
    docs = spark.createDataFrame([("x", " ".join(words)), ("x", "Abba")], "lang STRING, text STRING")
    rows = language.kneser_ney(language.run_counts(docs)).where("p IS NOT NULL").collect()
    expected = plain_kneser_ney([*words, "abba"])
    assert {r.run for r in rows} == set(expected)
    assert all(math.isclose(r.p, expected[r.run], rel_tol=1e-9) for r in rows)


def test_word_scores_sum_their_characters(spark):
    words = "abba abab cab bad dab a bb acab dabba".split()
    model = language.train(spark.createDataFrame([("x", " ".join(words)), ("y", "zed zoo zzz")], "lang STRING, text STRING"))
    expected = plain_kneser_ney(words)
    scores, sizes = model.held.word_scores(["abba", "cab"])
    for word, score, size in zip(("abba", "cab"), scores[:, 0], sizes):
        held = "   " + word + " "
        assert size == len(word) + 1
        assert math.isclose(score, sum(math.log(expected[held[i : i + 4]]) for i in range(size)), rel_tol=1e-4)


def plain_bits(models, text):
    """Bits per character in each language, run by run, with backing off by the formula."""

    def log_p(of, run):
        p, left = of
        if run in p:
            return math.log(p[run])
        if len(run) == 1:
            return math.log(1e-5)
        return math.log(left.get(run[:-1], 1.0)) + log_p(of, run[1:])

    found = []
    for of in models:
        total = chars = 0
        for word in language.letter_words(text):
            held = "   " + word + " "
            for i in range(len(word) + 1):
                total, chars = total + log_p(of, held[i : i + 4]), chars + 1
        found.append(-total / chars / math.log(2) if chars else None)
    return found


def test_sixty_languages_are_scored_by_all_their_runs(spark):
    """Held in arrays or joined, the model gives what the formula gives, nothing cut."""
    rnd = random.Random(60)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñçабвгдеж中文字語漢字"
    words = lambda own, n: " ".join("".join(rnd.choices(own, k=rnd.randint(1, 9))) for _ in range(n))
    alphabets = {f"l{i:02d}": rnd.sample(letters, 12) for i in range(60)}
    docs = [(i, words(alphabets[f"l{i % 60:02d}"], 40), f"l{i % 60:02d}") for i in range(240)] + [(900, None, "l00"), (901, "1 2", "l01")]
    frame_ = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING")
    table_ = language.kneser_ney(language.run_counts(frame_)).collect()
    models = []
    for lang in sorted(alphabets):
        rows = [r for r in table_ if r.lang == lang]
        models.append(({r.run: r.p for r in rows if r.p is not None}, {r.run: r.backoff for r in rows if r.p is None}))
    expected = {i: plain_bits(models, text or "") for i, text, _ in docs}
    for cells in (10**9, 0):
        model = language.train(frame_, language.LanguageSettings(model_cells=cells))
        assert (model.held is None) == (cells == 0)
        made = language.cross_entropies(frame_.repartition(3), model, "doc_id").collect()
        assert len(made) == len(docs)
        for r in made:
            if expected[r.doc_id][0] is None:
                assert r.bits is None
            else:
                assert all(math.isclose(x, y, rel_tol=1e-4) for x, y in zip(r.bits, expected[r.doc_id]))
    told = language.identify(frame_, F.lit(True), language.LanguageSettings(model_cells=0)).collect()
    right = {r.doc_id: r.lang_pred for r in told}
    assert all(right[i] == lang for i, text, lang in docs[:240]) and right[900] == right[901] == "und"


def test_languages_held_out(spark):
    found = QUERIES["op5_language_id"](spark, SF_DIR).join(
        table(spark, SF_DIR, "documents").select("doc_id", "lang"), "doc_id"
    )
    rows = found.where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_without_letters(spark):
    taught = [(50, "the cat sat on the mat"), (51, "le chat est sur la table")]
    docs = frame(spark, [*ODD, (20, "12 34 !!"), *taught], {50: "en", 51: "fr", **{i: None for i, _ in ODD}, 20: None})
    made = {r.doc_id: r for r in language.identify(docs, F.lit(True)).collect()}
    assert {made[i].lang_pred for i in (1, 2, 3, 20)} == {"und"}
    assert made[50].lang_pred == "en" and made[51].lang_pred == "fr" and made[7].lang_pred in ("en", "fr")
    nothing = language.identify(docs, F.col("doc_id") < 0)
    assert {r.lang_pred for r in nothing.collect()} == {"und"} and nothing.count() == len(ODD) + 3
    assert language.identify(docs.limit(0), F.lit(True)).count() == 0


def test_quality_held_out(spark):
    found = QUERIES["op6_quality_classifier"](spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.quality == r.predicted for r in rows) >= 0.97 * len(rows)


def test_quality_of_odd_texts(spark):
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choices(["aa", "bb", "cc"] if i % 2 else ["x!", "y#", "z$"], k=50))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (1, None, 0)], "doc_id BIGINT, quality INT, toxic INT")
    model = quality_classifier.train(frame(spark, docs), labels)
    scores = {r.doc_id: r.score for r in quality_classifier.score(frame(spark, docs + ODD), model).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in range(10, 60))
    assert all(0 <= s <= 1 for s in scores.values()) and {1, 2, 3} <= scores.keys()
    blank = quality_classifier.train(frame(spark, docs), labels.limit(0))
    assert all(abs(r.score - 0.5) < 0.1 for r in quality_classifier.score(frame(spark, ODD), blank).collect())
    assert quality_classifier.score(frame(spark, []), model).count() == 0


def test_margins_are_the_sum_over_all_pairs():
    """The sum-of-squares form against every pair of features."""
    rng = np.random.default_rng(3)
    size, rank = 40, 5
    machine = quality_classifier.FactorisationMachine(
        np.zeros((0, 3)), 0.7, rng.normal(size=size), rng.normal(size=(size, rank))
    )
    rows = [rng.integers(0, size, n) for n in (1, 2, 9, 30)]  # features may repeat within a row
    values = [rng.normal(size=len(r)) for r in rows]
    starts = np.cumsum([0, *map(len, rows)])[:-1]
    found = machine.margins(np.concatenate(rows), np.concatenate(values), starts)
    for margin, ids, x in zip(found, rows, values):
        expected = machine.bias + sum(machine.linear[i] * v for i, v in zip(ids, x))
        for a in range(len(ids)):
            for b in range(a):
                expected += machine.factors[ids[a]] @ machine.factors[ids[b]] * x[a] * x[b]
        assert math.isclose(margin, expected, rel_tol=1e-9, abs_tol=1e-9)


def test_one_row_of_a_repeated_id_is_learned_from(spark):
    docs = [(1, f"text number {i}") for i in range(50)] + [(2, "other")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id BIGINT, quality INT")
    one, other = (quality_classifier.train(frame(spark, d), labels) for d in (docs, docs[::-1]))
    assert np.array_equal(one.linear, other.linear)
