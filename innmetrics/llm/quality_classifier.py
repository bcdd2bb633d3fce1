"""Quality classifier: a factorisation machine over hashed words and structure.

Its score is w0 + sum(w_i x_i) plus the pairwise interactions <v_i, v_j> x_i x_j of all
features of a text. The latter are summed in time linear in the features, as half of
sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass, plain_words


@dataclass(frozen=True)
class QualityModelSettings:
    word_buckets: int = 1 << 16
    rank: int = 8
    #: At most so many labelled rows are fitted, those with the smallest hashed doc_id.
    sample_rows: int = 20_000
    bins: int = 10
    #: Passes over the sample; more if it is small, until so many batches were seen.
    epochs: int = 4
    least_batches: int = 600
    batch_rows: int = 64
    step: float = 0.08
    decay: float = 1e-3
    seed: int = 7


_RUNS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-Z]")
STATISTICS = (
    "words",
    "characters per word",
    "upper share",
    "digit share",
    "mark share",
    "symbol share",
    "different word share",
    "commonest word share",
    "equal neighbour share",
    "repeated line share",
    "lone mark share",
    "line length",
    "sentence length",
    "recorded length",
)


def structure(text: str, words: list[bytes], counts: Counter, n_chars: int | None) -> list[float]:
    """Statistics of a text. ``n_chars`` is the length that came with it, if any did."""
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    marks = sum(map(text.count, ".,;:!?"))
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(_UPPER.findall(text)) / size,
        sum(map(text.count, "0123456789")) / size,
        marks / n,
        sum(map(text.count, "#*$%&|<>@{}[]\\^~=+_")) / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(counts[bytes([c])] for c in b"|-*#.!") / n,
        np.log1p(len(text) / max(1, len(lines))),
        np.log1p(n / (1 + sum(map(text.count, ".!?")))),
        -1.0 if n_chars is None else float(n_chars == len(text)),
    ]


def word_features(counts: Counter, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and their weights, which have length 1 together."""
    ids = np.fromiter((zlib.crc32(w) for w in counts), np.int64, count=len(counts)) % buckets
    weights = np.log1p(np.fromiter(counts.values(), np.float64, count=len(counts)))
    return ids, weights / max(1e-9, float(np.sqrt((weights**2).sum())))


def raw_features(docs: DataFrame, settings: QualityModelSettings, *carried: str) -> DataFrame:
    """ids, weights and statistics of each text, with the columns ``carried`` (bigints)."""

    def step(texts, sizes, *others):
        rows = []
        for text, n_chars in zip(texts, sizes):
            text = text or ""
            words = plain_words(text)
            counts = Counter(words)
            ids, weights = word_features(counts, settings.word_buckets)
            rows.append((ids.astype(np.int32), weights, structure(text, words, counts, n_chars)))
        return [*(list(zip(*rows)) or [[], [], []]), *others]

    ddl = "ids ARRAY<INT>, weights ARRAY<DOUBLE>, statistics ARRAY<DOUBLE>"
    ddl += "".join(f", {c} BIGINT" for c in carried)
    return arrow_pass(_with_length(docs), ["text", "n_chars", *carried], ddl, step)


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        return docs.withColumn("n_chars", F.col("n_chars").cast("bigint"))
    return docs.withColumn("n_chars", F.lit(None).cast("bigint"))


@dataclass
class FactorisationMachine:
    """Weights of hashed words first, then of each bin of each statistic."""

    edges: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, ids: list, weights: list, statistics: list, buckets: int):
        """Feature ids and values of some rows, with the place where each row starts."""
        held, bins = np.asarray(statistics, float).reshape(len(ids), -1), self.edges.shape[1] + 1
        placed = np.stack([np.searchsorted(e, held[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)
        placed = buckets + placed + bins * np.arange(len(self.edges))
        sizes = np.array([len(i) for i in ids], np.int64) + placed.shape[1]
        features = np.concatenate([np.concatenate([i, p]) for i, p in zip(ids, placed)]).astype(np.int64)
        value = 1 / np.sqrt(placed.shape[1])
        values = np.concatenate([np.concatenate([w, np.full(placed.shape[1], value)]) for w in weights])
        return features, values, np.cumsum(sizes) - sizes

    def margins(self, features: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        terms = self.factors[features] * values[:, None]
        sums = np.add.reduceat(terms, starts, axis=0)
        squares = np.add.reduceat((terms**2).sum(axis=1), starts)
        linear = np.add.reduceat(self.linear[features] * values, starts)
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(ids: list, weights: list, statistics: list, labels: np.ndarray, settings: QualityModelSettings):
    """Logistic loss, AdaGrad on the features that each batch holds."""
    rng = np.random.default_rng(settings.seed)
    k = len(STATISTICS)
    held = np.asarray(statistics, float).reshape(-1, k)
    cuts = np.linspace(0, 1, settings.bins + 1)[1:-1]
    edges = np.quantile(held, cuts, axis=0).T if len(held) else np.zeros((k, len(cuts)))
    size = settings.word_buckets + k * settings.bins
    model = FactorisationMachine(edges, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, settings.rank)))
    if not len(labels):
        return model
    share = np.clip(labels.mean(), 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, settings.rank), 1e-2), 1e-2
    batches = -(-len(labels) // settings.batch_rows)
    for _ in range(max(settings.epochs, -(-settings.least_batches // batches))):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), settings.batch_rows):
            chosen = order[begin : begin + settings.batch_rows]
            features, values, starts = model.rows(
                [ids[i] for i in chosen], [weights[i] for i in chosen], held[chosen], settings.word_buckets
            )
            sizes = np.diff(np.append(starts, len(features)))
            error = (sigmoid(model.margins(features, values, starts)) - labels[chosen])
            each = np.repeat(error, sizes) * values
            terms = model.factors[features] * values[:, None]
            sums = np.repeat(np.add.reduceat(terms, starts, axis=0), sizes, axis=0)
            used, place = np.unique(features, return_inverse=True)
            slope_w = np.bincount(place, each, len(used)) + settings.decay * model.linear[used]
            slope_v = np.stack(
                [np.bincount(place, each * (sums[:, f] - terms[:, f]), len(used)) for f in range(settings.rank)], axis=1
            ) + settings.decay * model.factors[used]
            seen_w[used] += slope_w**2
            seen_v[used] += slope_v**2
            seen_b += error.sum() ** 2
            model.linear[used] -= settings.step * slope_w / np.sqrt(seen_w[used])
            model.factors[used] -= settings.step * slope_v / np.sqrt(seen_v[used])
            model.bias -= settings.step * error.sum() / np.sqrt(seen_b)
    return model


def train(docs: DataFrame, labels: DataFrame, settings: QualityModelSettings = QualityModelSettings()):
    """The model of at most ``sample_rows`` labelled rows (doc_id, quality).

    Where ids repeat with different labels the lower counts, and of the rows of one id the
    first in order, so no more rows come to the driver than ids are sampled; null ids and
    labels are left out. Without labels every text scores one half.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("bigint").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.sample_rows)
    )
    wanted = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    rows = docs.select(*wanted).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
    rows = rows.agg(F.min(F.struct(*[c for c in wanted if c != "doc_id"])).alias("first")).select("doc_id", "quality", "first.*")
    found = raw_features(rows, settings, "quality", "doc_id").toArrow().sort_by("doc_id")
    column = lambda name: [np.asarray(v.values) for v in found[name]]
    return fit(column("ids"), column("weights"), column("statistics"), found["quality"].to_numpy().astype(float), settings)


def score(docs: DataFrame, model: FactorisationMachine, settings: QualityModelSettings = QualityModelSettings()):
    """doc_id, score (0 to 1, the chance of label 1). Reads doc_id, text and n_chars where
    there is one; a null text counts as empty, which has a score too. Repeated rows give
    repeated results."""
    scored = with_score(docs, model, "score", settings)
    return scored.select("doc_id", "score")


def with_score(
    docs: DataFrame,
    model: FactorisationMachine,
    name: str,
    settings: QualityModelSettings = QualityModelSettings(),
) -> DataFrame:
    """The rows with their score as one more column, which must be a new name."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts, sizes):
        own, out = sent.value, []
        for begin in range(0, len(texts), 512):
            rows = []
            for text, n_chars in zip(texts[begin : begin + 512], sizes[begin : begin + 512]):
                text, n_chars = text or "", None if n_chars is None or n_chars != n_chars else n_chars
                words = plain_words(text)
                counts = Counter(words)
                rows.append((*word_features(counts, settings.word_buckets), structure(text, words, counts, n_chars)))
            out.append(sigmoid(own.margins(*own.rows(*zip(*rows), settings.word_buckets))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    sizes = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.withColumn(name, scored("text", sizes))
