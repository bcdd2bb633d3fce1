"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Runs of SEED_WORDS words of the test items are looked for in every text. Each run that an
item and a text share is a seed, so any stretch of SEED_WORDS equal words leaves one,
whatever other texts hold. Where seeds of an item meet a text, they are merged by where
the item would start, and the item is aligned with the words around.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass, bit_filter, passes, written

SEED_WORDS = 4
#: Bits of the filter that is sent to all tasks: 2 MB whatever the number of items.
FILTER_BITS = 1 << 24
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the full score of an item from which a text holds a copy of it.
MIN_SIMILARITY = 0.5


# All bytes but those of ASCII letters and digits and of other characters become spaces.
_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case runs of letters and digits; what stands between them doesn't count."""
    return text.lower().encode().translate(_WORDS).split() if text else []


def run_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of each run of SEED_WORDS words, as signed integers."""
    n = len(words) - SEED_WORDS + 1
    if n < 1:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(zlib.crc32, words), np.uint64, count=len(words))
    mixed = np.full(n, np.uint64(SEED_WORDS))
    with np.errstate(over="ignore"):
        for i in range(SEED_WORDS):
            mixed = (mixed ^ each[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def numbered_items(benchmark: DataFrame) -> DataFrame:
    """item, item_id, text: every different item with a number of its own. One id may
    stand for several texts."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    return written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")


def item_runs(items: DataFrame) -> DataFrame:
    """item, at, run, n_words of every run of every item."""

    def step(ids, texts):
        rows = []
        for item, text in zip(ids, texts):
            words = words_of(text)
            rows += [(item, at, int(run), len(words)) for at, run in enumerate(run_hashes(words))]
        return list(zip(*rows)) or [[], [], [], []]

    return arrow_pass(
        items,
        ["item", "text"],
        "item BIGINT, at BIGINT, run BIGINT, n_words BIGINT",
        step,
    )


def text_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, pos, run: the runs of all texts that pass the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter(runs, "run", FILTER_BITS))

    def step(ids, texts):
        flags, found_ids, places, found = sent.value, [], [], []
        for doc_id, text in zip(ids, texts):
            hashes = run_hashes(words_of(text))
            at = np.flatnonzero(passes(flags, hashes))
            if len(at):
                found_ids.append(np.full(len(at), doc_id))
                places.append(at)
                found.append(hashes[at])
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return joined(found_ids), joined(places), joined(found)

    return arrow_pass(
        docs.where("doc_id IS NOT NULL"), ["doc_id", "text"], "doc_id BIGINT, pos BIGINT, run BIGINT", step
    )


def smith_waterman(texts: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its text; words are numbers.

    All pairs advance together, one item word at a time. A gap in the item is a running
    maximum along the text: H[j] = max over k <= j of T[k] + GAP * (j - k).
    """
    if not texts:
        return np.zeros(0, np.int64)
    width, height = max(map(len, texts)), max(map(len, items))
    text = np.full((len(texts), max(1, width)), -1, np.int64)
    item = np.full((len(items), max(1, height)), -2, np.int64)
    for i, (a, b) in enumerate(zip(texts, items)):
        text[i, : len(a)], item[i, : len(b)] = a, b
    ramp = -GAP * np.arange(text.shape[1])
    scores = np.zeros((len(texts), text.shape[1] + 1), np.int64)
    best = np.zeros(len(texts), np.int64)
    for at in range(item.shape[1]):
        equal = text == item[:, at : at + 1]
        reached = np.maximum(scores[:, :-1] + np.where(equal, MATCH, MISMATCH), scores[:, 1:] + GAP)
        reached = np.maximum(reached, 0)
        scores[:, 1:] = np.maximum.accumulate(reached + ramp, axis=1) - ramp
        best = np.maximum(best, scores.max(axis=1))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """doc_id, item_id, score, similarity of every text that holds a copy of an item.

    ``similarity`` is the alignment score as a share of that of the whole item. Reads
    doc_id and text, item_id and text; other columns are ignored, null ids left out. Items
    of fewer than SEED_WORDS words can't be told from chance and are never found. Repeated
    rows of one text or item give one row; of several texts of one item_id, each is looked
    for, and the best score counts. An empty table on either side gives none.
    """
    items = numbered_items(benchmark)
    runs = written(item_runs(items), "item-runs")
    found = written(text_runs(docs, runs), "text-runs")
    places = (
        found.join(runs, "run")
        .select("doc_id", "item", "n_words", (F.col("pos") - F.col("at")).alias("start"))
        .groupBy("doc_id", "item", "n_words", F.floor(F.col("start") / F.col("n_words")).alias("part"))
        .agg(F.min("start").alias("low"), F.max("start").alias("high"))
    )
    asked = (
        places.join(items.withColumnRenamed("text", "item_text"), "item")
        .select("doc_id", F.struct("item_id", "item_text", "n_words", "low", "high").alias("place"))
        .groupBy("doc_id")
        .agg(F.collect_list("place").alias("places"))
        .select(
            "doc_id",
            *[F.col(f"places.{c}").alias(f"{c}s") for c in ("item_id", "item_text", "n_words", "low", "high")],
        )
    )

    def step(ids, texts, item_ids, items, sizes, lows, highs):
        owners, regions, wanted = [], [], []
        for row, text in enumerate(texts):
            words, numbers = words_of(text), {}
            own = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
            for i, item in enumerate(items[row]):
                slack = sizes[row][i] // 2
                low = max(0, lows[row][i] - slack)
                regions.append(own[low : highs[row][i] + sizes[row][i] + slack])
                wanted.append(np.array([numbers.get(w, -3) for w in words_of(item)], np.int64))
                owners.append((ids[row], item_ids[row][i]))
        best: dict[tuple[int, int], tuple[int, float]] = {}
        order = sorted(range(len(owners)), key=lambda i: (len(regions[i]), len(wanted[i])))
        for begin in range(0, len(order), 256):
            part = order[begin : begin + 256]
            scores = smith_waterman([regions[i] for i in part], [wanted[i] for i in part])
            for i, score in zip(part, scores.tolist()):
                share = score / (MATCH * len(wanted[i]))
                if share >= min_similarity:
                    best[owners[i]] = max(best.get(owners[i], (0, 0.0)), (score, share))
        rows = [(*owner, *value) for owner, value in best.items()]
        return list(zip(*rows)) or [[], [], [], []]

    aligned = arrow_pass(
        docs.select("doc_id", "text").join(asked, "doc_id"),
        ["doc_id", "text", "item_ids", "item_texts", "n_wordss", "lows", "highs"],
        "doc_id BIGINT, item_id BIGINT, score BIGINT, similarity DOUBLE",
        step,
        256,
    )
    return aligned.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("similarity").alias("similarity"))
