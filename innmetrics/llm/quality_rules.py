"""Quality rules: counts of a text, and its distance from what its language looks like."""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass, word_ids, written

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the verdict. Distances are Jensen-Shannon distances (0 equal, 1 disjoint)."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_class_distance: float = 0.25
    max_word_distance: float = 0.45
    #: Below these sizes a histogram says too little and its rule passes.
    min_chars: int = 200
    min_histogram_words: int = 60
    #: Words that make the histogram of a language.
    common_words: int = 40


# Classes of characters, told by the first byte of their UTF-8 form. The first
# bytes from which scripts begin, up to the next line's.
_ASCII = ("lower", "upper", "digit", "white", "sentence mark", "symbol")
_SCRIPTS = (
    (0xC2, "latin"), (0xCA, "phonetic"), (0xCD, "greek"), (0xD0, "cyrillic"), (0xD4, "armenian"), (0xD6, "hebrew"),
    (0xD8, "arabic"), (0xDC, "syriac"), (0xDE, "other two bytes"), (0xE0, "indic"), (0xE1, "other three bytes"),
    (0xE2, "general sign"), (0xE3, "kana"), (0xE4, "han"), (0xEA, "hangul"), (0xEE, "private or form"), (0xF0, "four bytes"),
)
_CLASSES = (*_ASCII, *[name for _, name in _SCRIPTS])
_INSIDE = len(_CLASSES)


def _class_of_byte() -> np.ndarray:
    kinds = np.full(256, _ASCII.index("symbol"), np.int64)
    kinds[0x80:] = _INSIDE  # inside a character
    for first, name in _SCRIPTS:
        kinds[first:] = _CLASSES.index(name)
    for code in range(128):
        ch = chr(code)
        if ch.islower():
            kinds[code] = 0
        elif ch.isupper():
            kinds[code] = 1
        elif ch.isdigit():
            kinds[code] = 2
        elif ch in _WHITE:
            kinds[code] = 3
        elif ch in ".,;:!?'\"()-":
            kinds[code] = 4
    return kinds


_KIND = _class_of_byte()
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def class_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=_INSIDE + 1)[:_INSIDE]


def letter_words(raw: bytes) -> list[bytes]:
    return raw.translate(_LETTERS).split()


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``window`` words that occur at least twice. A window's
    number comes from the numbers of its halves, so equal numbers mean equal words."""
    if len(words) <= window:
        return 0
    ids, width = word_ids(words), 1
    while width < window:
        pairs = ids[:-width] << 32 | ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(ids)[ids] > 1
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:-window][twice] += 1
    steps[window:][twice] -= 1
    return int((np.cumsum(steps) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, _WHITE))
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return (
        len(words),
        chars,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms with base 2; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def language_histograms(docs: DataFrame) -> DataFrame:
    """lang, kind (class or word), item, n and all: counts over all texts; a null lang
    counts as ''. Each task adds up what it reads before anything is shuffled."""

    def step(langs, texts):
        counts: dict[tuple, Counter] = defaultdict(Counter)
        for lang, text in zip(langs, texts):
            if text:
                raw = text.encode()
                counts[lang or "", "class"].update(
                    {name: int(n) for name, n in zip(_CLASSES, class_histogram(raw)) if n}
                )
                counts[lang or "", "word"].update(letter_words(raw))
        found = [
            (lang, kind, item if kind == "class" else item.decode(errors="replace"), n)
            for (lang, kind), items in counts.items()
            for item, n in items.items()
        ]
        return list(zip(*found)) or [[], [], [], []]

    return (
        arrow_pass(docs, ["lang", "text"], "lang STRING, kind STRING, item STRING, n BIGINT", step)
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )


def references(docs: DataFrame, rules: QualityRules = QualityRules()) -> tuple[DataFrame, str | None]:
    """lang, reference of every language, and that of all languages together (None if no
    text has anything). A reference holds the class histogram, the commonest words with
    their counts and the number of all words, as JSON of some 60 entries."""
    counts = written(language_histograms(docs), "language-histograms")
    words, classes = counts.where("kind = 'word'"), counts.where("kind = 'class'")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    top = words.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rules.common_words).drop("place")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    totals = totals.select("lang", F.lit("total").alias("kind"), F.lit("").alias("item"), "n")
    parts = written(top.unionByName(classes).unionByName(totals), "language-references")
    listed = lambda: F.to_json(F.sort_array(F.collect_list(F.struct("kind", "item", "n")))).alias("reference")
    pooled = parts.groupBy("kind", "item").agg(F.sum("n").alias("n"))
    common = pooled.where("kind = 'word'").orderBy(F.desc("n"), "item").limit(rules.common_words)
    together = pooled.where("kind <> 'word'").unionByName(common).agg(listed()).first().reference
    return parts.groupBy("lang").agg(listed()), together if together != "[]" else None


@lru_cache(maxsize=4096)
def histograms(reference: str) -> tuple[np.ndarray, dict[bytes, int], np.ndarray]:
    """Class histogram, the words with their places, and their counts with that of all
    others last."""
    by_kind: dict[str, dict[str, int]] = {"class": {}, "word": {}, "total": {}}
    for part in json.loads(reference):
        by_kind[part["kind"]][part["item"]] = part["n"]
    words = sorted(by_kind["word"], key=lambda w: (-by_kind["word"][w], w))
    common = [by_kind["word"][w] for w in words]
    return (
        np.array([by_kind["class"].get(c, 0) for c in _CLASSES], float),
        {w.encode(): i for i, w in enumerate(words)},
        np.array([*common, by_kind["total"].get("", 0) - sum(common)], float),
    )


def distances(raw: bytes, reference: tuple, rules: QualityRules) -> tuple[float, float]:
    """Distances of the class and of the word histogram; 0 where a guard holds."""
    classes, words, common = reference
    own = class_histogram(raw)
    class_distance = js_distance(own, classes) if own.sum() >= rules.min_chars else 0.0
    found = letter_words(raw)
    if len(found) < rules.min_histogram_words:
        return class_distance, 0.0
    places = [i for i in map(words.get, found) if i is not None]
    counts = np.bincount(places, minlength=len(words) + 1).astype(float)
    counts[-1] = len(found) - len(places)
    return class_distance, js_distance(counts, common)


def quality_rules(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """doc_id, base counts, base_failed, both distances and the verdict ``kept``.

    Reads doc_id, text and lang; other columns are ignored. A null text counts as empty and
    is not kept (no words). Every language has a reference of its own; rows without one are
    compared with all texts together. Equally common words count in their own order.
    Repeated rows give repeated results; an empty table gives none.
    """
    found, together = references(docs, rules)
    rows = docs.select("doc_id", "lang", "text").join(found, "lang", "left")  # a row per language

    def step(ids, texts, own_references):
        rows = []
        for doc_id, text, own in zip(ids, texts, own_references):
            counts = base_counts(text or "")
            failed = counts[0] < rules.min_words or 100 * counts[4] > rules.max_repeat_percent * counts[0]
            reference = own or together
            near = distances((text or "").encode(), histograms(reference), rules) if reference else (0.0, 0.0)
            kept = not failed and near[0] <= rules.max_class_distance and near[1] <= rules.max_word_distance
            rows.append((doc_id, *counts, failed, kept, *near))
        return list(zip(*rows))

    return arrow_pass(
        rows,
        ["doc_id", "text", "reference"],
        "doc_id BIGINT, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
        "n_repeat_words BIGINT, base_failed BOOLEAN, kept BOOLEAN, class_distance DOUBLE, word_distance DOUBLE",
        step,
    )
