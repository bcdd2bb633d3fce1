"""Language identification with interpolated Kneser-Ney character models.

A text is a sequence of lower-case words of letters; a model predicts each letter, and the
end of a word, from up to ORDER - 1 characters before it in the word. Counts come from all
training texts; probabilities are worked out by Spark and kept as arrays sorted by the
hash of the character run.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass, arrow_schema, written

ORDER = 4
#: Log probability of a character that a language never had.
UNSEEN = np.log(1e-5)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageSettings:
    #: Numbers of a model that is sent to the tasks; a larger one is joined with the texts.
    model_cells: int = 16_000_000
    #: Share of a language's training texts below its rejection limit, and what is added.
    quantile: float = 0.999
    slack: float = 0.15


def letter_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _padded(words: list[str]) -> str:
    return "".join(" " * (ORDER - 1) + w + " " for w in words)


def run_counts(docs: DataFrame) -> DataFrame:
    """lang, run, n: how often each run of ORDER characters ends in a word's letter or end.
    Counted per task before anything is shuffled."""

    def step(langs, texts):
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(langs, texts):
            words[lang].update(letter_words(text))
        found = []
        for lang, counts in words.items():
            runs: Counter = Counter()
            for word, n in counts.items():
                held = _padded([word])
                for i in range(len(held) - ORDER + 1):
                    runs[held[i : i + ORDER]] += n
            found += [(lang, run, n) for run, n in runs.items()]
        return list(zip(*found)) or [[], [], []]

    rows = arrow_pass(docs, ["lang", "text"], "lang STRING, run STRING, n BIGINT", step)
    return rows.groupBy("lang", "run").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """lang, size, run, p, n: the interpolated probability of a run's last character after
    the others; lang, size, run, backoff: what a context leaves to shorter ones. Both in
    one table, with p null for the latter.

    Below the longest runs a count is the number of different characters seen before.
    """
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        longer = levels[size + 1]
        levels[size] = longer.groupBy("lang", F.substring("run", 2, size).alias("run")).agg(F.count("*").alias("n"))
    tables, lower = [], None
    for size in range(1, ORDER + 1):
        level = levels[size].withColumn("context", F.substring("run", 1, size - 1))
        of_context = level.groupBy("lang", "context").agg(
            F.sum("n").alias("total"),
            F.count("*").alias("kinds"),
            F.sum((F.col("n") == 1).cast("double")).alias("ones"),
            F.sum((F.col("n") == 2).cast("double")).alias("twos"),
        )
        ones, twos = F.sum("ones"), F.sum("twos")
        discount = of_context.groupBy("lang").agg(
            F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5).alias("discount")
        )
        held = of_context.join(F.broadcast(discount), "lang").withColumn(
            "backoff", F.col("discount") * F.col("kinds") / F.col("total")
        )
        joined = level.join(held, ["lang", "context"]).withColumn("suffix", F.substring("run", 2, size))
        if lower is None:
            joined = joined.withColumn("p_lower", 1 / (F.col("kinds") + 1))
        else:
            joined = joined.join(lower, ["lang", "suffix"])
        own = (F.col("n") - F.col("discount")) / F.col("total") + F.col("backoff") * F.col("p_lower")
        probabilities = joined.select("lang", F.lit(size).alias("size"), "run", own.alias("p"), "n")
        tables.append(probabilities.withColumn("backoff", F.lit(None).cast("double")))
        tables.append(
            held.select(
                "lang",
                F.lit(size).alias("size"),
                F.col("context").alias("run"),
                F.lit(None).cast("double").alias("p"),
                F.col("total").alias("n"),
                "backoff",
            )
        )
        lower = probabilities.select("lang", F.col("run").alias("suffix"), F.col("p").alias("p_lower"))
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    return whole


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class CharacterModel:
    """Sorted hashes of character runs, and for each run one column per language with the
    log probability of its last character (nan where the language never had it) and one
    with what it leaves, as a context, to shorter ones (0 where it leaves all)."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, marks: np.ndarray, values: np.ndarray, width: int):
        """``sizes`` entries of each key: a mark is 2 * language, plus 1 for what is left."""
        self.width = width
        order = np.argsort(keys)
        self.keys = keys[order]
        row = np.empty(len(keys), np.int64)
        row[order] = np.arange(len(keys))
        row = np.repeat(row, sizes)
        held = np.zeros((2, len(keys), width), np.float32)
        held[0] = np.nan
        held[marks & 1, row, marks >> 1] = values
        self.own, self.left = held

    def _rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return at, (self.keys[at] == hashes) if len(self.keys) else np.zeros(len(hashes), bool)

    def log_p(self, runs: np.ndarray) -> np.ndarray:
        """Log probability in each language of the last of the codes in each row."""
        size = runs.shape[1]
        at, known = self._rows(hash_rows(runs))
        found = np.full((len(runs), self.width), np.nan)
        found[known] = self.own[at[known]]
        if size == 1:
            return np.where(np.isnan(found), UNSEEN, found)
        short = np.flatnonzero(np.isnan(found).any(axis=1))
        if len(short):
            at, known = self._rows(hash_rows(runs[short, :-1]))
            left = np.where(known[:, None], self.left[at], 0.0) if len(self.keys) else 0.0
            fallen = self.log_p(runs[short, 1:]) + left
            found[short] = np.where(np.isnan(found[short]), fallen, found[short])
        return found

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities per language and numbers of predicted characters of words.
        Each different run of the words is looked up once."""
        held = PaddedWords(words)
        scores = np.zeros((len(held.codes), self.width))
        scores[held.ends] = self.log_p(held.rows[held.firsts])[held.which]
        return np.add.reduceat(scores, held.starts, axis=0), held.lengths - (ORDER - 1)


class PaddedWords:
    """The runs of ORDER characters that words are predicted by."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) + ORDER for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = _codes(_padded(words))
        place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        self.ends = np.flatnonzero(place >= ORDER - 1)
        self.rows = np.stack([self.codes[self.ends - back] for back in range(ORDER - 1, -1, -1)], axis=1)
        _, self.firsts, self.which = np.unique(hash_rows(self.rows), return_index=True, return_inverse=True)

    def keys(self) -> np.ndarray:
        """Hashes of all that scoring may look up: every run, its contexts and its endings."""
        runs = self.rows[self.firsts]
        parts = [hash_rows(runs[:, low:high]) for low in range(ORDER) for high in range(low + 1, ORDER + 1)]
        return np.unique(np.concatenate([hash_rows(runs[:1, :0]), *parts]))


def hash_rows(runs: np.ndarray) -> np.ndarray:
    """Hash of the codes in each row; rows of another width have other hashes."""
    mixed = np.full(len(runs), np.uint64(runs.shape[1] + 1))
    with np.errstate(over="ignore"):
        for i in range(runs.shape[1]):
            mixed = (mixed ^ runs[:, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


@dataclass(frozen=True)
class TrainedModel:
    """The whole model as a written table (key, marks, values), and its languages in order.
    ``held`` is the same in arrays, if it is small enough to be sent to every task."""

    table: DataFrame
    languages: list[str]
    held: CharacterModel | None


def train(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> TrainedModel | None:
    """The model of all rows with a language (text, lang); None if there are none.

    Counts and probabilities cover every text, and every run that any language had is kept.
    """
    counts = written(run_counts(docs.where("lang IS NOT NULL")), "language-runs")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}

    def step(langs, runs, values, kinds):
        by_size = defaultdict(list)
        for i, run in enumerate(runs):
            by_size[len(run)].append(i)
        keys = np.zeros(len(runs), np.int64)
        for size, at in by_size.items():
            keys[at] = hash_rows(_codes("".join(runs[i] for i in at)).reshape(len(at), size))
        marks = [2 * place[lang] + kind for lang, kind in zip(langs, kinds)]
        return keys, marks, np.log(np.array(values, np.float64))

    rows = kneser_ney(counts).select(
        "lang", "run", F.coalesce("p", "backoff").alias("value"), F.col("p").isNull().cast("int").alias("kind")
    )
    hashed = arrow_pass(rows, ["lang", "run", "value", "kind"], "key BIGINT, mark INT, value DOUBLE", step, 65536)
    entry = F.collect_list(F.struct("mark", "value")).alias("entries")  # two per language at most
    keyed = hashed.groupBy("key").agg(entry).select(
        "key", F.col("entries.mark").alias("marks"), F.col("entries.value").cast("array<float>").alias("values")
    )
    table = written(keyed, "language-model")
    small = 2 * table.count() * len(languages) <= settings.model_cells
    return TrainedModel(table, languages, model_of(table.toArrow(), len(languages)) if small else None)


def model_of(rows: pa.Table, width: int) -> CharacterModel:
    rows = rows.combine_chunks()
    flat = lambda name: rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = rows.column("marks").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return CharacterModel(rows.column("key").to_numpy(), sizes, flat("marks"), flat("values"), width)


class CountedWords:
    """The different words of some texts, and how often each text has which."""

    def __init__(self, texts: list):
        counts = [Counter(letter_words(t)) for t in texts]
        place: dict[str, int] = {}
        at = [place.setdefault(word, len(place)) for c in counts for word in c]
        self.words = list(place)
        self.sizes = np.array(list(map(len, counts)), np.int64)
        self.at = np.array(at, np.int64)
        self.times = np.array([n for c in counts for n in c.values()], np.int64)


def bits_per_character(words: list[str], sizes, at, times, model: CharacterModel) -> list:
    """Cross-entropy of each text in every language; None for texts without words."""
    if not words:
        return [None] * len(sizes)
    scores, lengths = model.word_scores(words)
    ends = np.cumsum(sizes)
    running = lambda values: np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    sums, chars = running(scores[at] * times[:, None]), running(lengths[at] * times)
    bits = -(sums[ends] - sums[ends - sizes])
    totals = chars[ends] - chars[ends - sizes]
    return [b / n / np.log(2) if n else None for b, n in zip(bits, totals)]


def cross_entropies(docs: DataFrame, model: TrainedModel | None, *carried: str) -> DataFrame:
    """Bits per character of every whole text in each language of the model, in its order
    (null if the text has no letter), with the columns ``carried``."""
    if model is not None and model.held is None:
        return _joined_cross_entropies(docs, model, *carried)
    sent = docs.sparkSession.sparkContext.broadcast(model and model.held)

    def step(texts, *others):
        if sent.value is None:
            return [[None] * len(texts), *others]
        counted = CountedWords(texts)
        return [bits_per_character(counted.words, counted.sizes, counted.at, counted.times, sent.value), *others]

    return arrow_pass(docs, ["text", *carried], _bits_ddl(docs, carried), step)


def _bits_ddl(docs: DataFrame, carried) -> str:
    kinds = dict(docs.dtypes)
    return "bits ARRAY<DOUBLE>" + "".join(f", {c} {kinds[c].upper()}" for c in carried)


def _joined_cross_entropies(docs: DataFrame, model: TrainedModel, *carried: str, rows_of_block: int = 1024) -> DataFrame:
    """The same with a model of any size: blocks of texts name the runs they need, Spark
    joins these with the model table, and each block gets a model of its own runs."""
    kinds = dict(docs.dtypes)
    of_block = ["words ARRAY<STRING>", "sizes ARRAY<BIGINT>", "at ARRAY<BIGINT>", "times ARRAY<BIGINT>", "keys ARRAY<BIGINT>"]
    ddl = ", ".join(["block BIGINT", *of_block, *[f"{c} ARRAY<{kinds[c].upper()}>" for c in carried]])
    schema, width = arrow_schema(ddl), len(model.languages)

    def blocks(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, rows_of_block):
                texts, *others = [c.to_pylist() for c in batch.slice(start, rows_of_block).columns]
                own = CountedWords(texts)
                keys = PaddedWords(own.words).keys() if own.words else []
                row = (number, own.words, own.sizes, own.at, own.times, keys, *others)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                number += 1

    made = written(docs.select("text", *carried).mapInArrow(blocks, ddl), "language-blocks")
    asked = made.select(F.col("block").alias("of_block"), F.explode("keys").alias("key")).join(model.table, "key")
    out_ddl = _bits_ddl(docs, carried)

    def finish(key, own: pa.Table, found: pa.Table) -> pa.Table:
        held = {name: own.column(name)[0] for name in own.column_names}
        numbers = [np.array(held[c].values, np.int64) for c in ("sizes", "at", "times")]
        bits = bits_per_character(held["words"].as_py(), *numbers, model_of(found, width))
        arrays = [pa.array(bits, pa.list_(pa.float64())), *[held[c].values for c in carried]]
        return pa.Table.from_arrays(arrays, schema=arrow_schema(out_ddl))

    return made.drop("keys").groupBy("block").cogroup(asked.groupBy("of_block")).applyInArrow(finish, out_ddl)


def identify(docs: DataFrame, learn: Column, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_char, rejected of every row.

    ``learn`` tells the rows of ``docs`` to learn from; of them those with a lang count.
    The language is that of the lowest cross-entropy, ``und`` for a text that is null or
    has no letter, or if nothing could be learned. ``score`` is the weight of the chosen
    language among all. A text is ``rejected`` if its cross-entropy is above the limit of
    the chosen language: a high quantile over the texts learned from that were told right,
    and some slack. Ties go to the first by name. Reads doc_id, text and lang; repeated
    rows give repeated results. Every text is scored once, and the scores are written.
    """
    taught = F.when(learn, F.col("lang")).alias("taught")
    rows = docs.select("doc_id", "text", taught)
    model = train(rows.select("text", F.col("taught").alias("lang")), settings)
    names = F.array(*[F.lit(x) for x in (model.languages if model else [])]).cast("array<string>")
    least = F.array_min("bits")
    weight = F.aggregate("bits", F.lit(0.0), lambda total, b: total + F.exp(8 * (least - b)))
    told = F.get(names, (F.array_position("bits", least) - 1).cast("int"))
    scored = written(
        cross_entropies(rows, model, "doc_id", "taught").select(
            "doc_id",
            "taught",
            F.coalesce(told, F.lit("und")).alias("lang_pred"),
            F.coalesce(1 / weight, F.lit(0.0)).alias("score"),
            least.alias("bits_per_char"),
        ),
        "language-scores",
    )
    limits = (
        scored.where("taught = lang_pred")
        .groupBy("lang_pred")
        .agg((F.percentile_approx("bits_per_char", settings.quantile, 10_000) + settings.slack).alias("limit"))
    )
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(
        "doc_id", "lang_pred", "score", "bits_per_char", (F.col("bits_per_char") > F.col("limit")).alias("rejected")
    )
