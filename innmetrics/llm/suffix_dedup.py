"""Removal of repeated byte strings by external induced sorting of suffixes.

Sampled suffixes take the place of the smallest suffixes of induced sorting: the anchors,
one per window, chosen by content (see ``anchors``). Spark's shuffle and spilling sort is
the queue on disk: it deals suffix tuples (anchor hash, bytes from the anchor on, bytes
before it, document) by hash and brings them in order, so no task needs more than one
anchor's tuples in memory. From the order of the suffixes at the anchors that of the
suffixes one byte earlier is induced by the byte put in front, and so on; the lengths of
the common prefixes of neighbours are carried along. Neighbours that share WINDOW bytes
are equal strings, and the smallest document among them keeps its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innmetrics.llm.anchors import RUN, WINDOW, find_anchors
from innmetrics.llm.common import arrow_pass, arrow_schema, bit_filter, passes, written

#: Bytes that can stand before the anchor in a window.
BEFORE = WINDOW - RUN
#: Flags of the filters that go to all tasks: 16 and 2 MB whatever the input.
FILTER_BITS = 1 << 27
COPY_FILTER_BITS = 1 << 24
#: An anchor with more tuples is split by the whole window instead of being one group.
HOT_TUPLES = 200_000
#: Tuples that a task sorts together, if no single anchor has more.
BLOCK_TUPLES = 100_000

#: A suffix tuple: bytes from the anchor on, bytes before it from the nearest on, then
#: document, text, place of the anchor and the first and last step of its windows.
_TUPLE = np.dtype(
    [
        ("after", "u1", (WINDOW,)),
        ("before", "u1", (BEFORE,)),
        ("doc_id", "<i8"),
        ("text", "<i8"),
        ("place", "<i8"),
        ("first", "u1"),
        ("last", "u1"),
    ]
)
_RUNS = "text BIGINT, low BIGINT, high BIGINT"


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts end to end, and where each starts and ends."""
    raws = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(raws), np.uint8), ends - sizes, ends


def taken(copied: np.ndarray, digests: list[int | None]) -> list[int]:
    """Places of the rows to work on: those of null ``digest``, and those of which the
    filter says that no other row has the text. The steps do this themselves, so that a
    task needs one Python worker."""
    hashes = np.array([0 if d is None else d for d in digests], np.int64)
    hit = passes(copied, hashes)
    return [i for i, d in enumerate(digests) if d is None or not hit[i]]


def anchor_counts(texts: DataFrame, copied: np.ndarray) -> DataFrame:
    """hash, n_texts, n: of how many texts and how often, added up per step."""
    sent = texts.sparkSession.sparkContext.broadcast(copied)

    def step(texts, digests):
        texts = [texts[i] for i in taken(sent.value, digests)]
        raw, starts, ends = laid_out(texts)
        text, hashes, *_ = find_anchors(raw, starts, ends)
        order = np.lexsort((text, hashes))
        text, hashes = text[order], hashes[order]
        new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
        other = new | np.append(True, text[1:] != text[:-1])[: len(hashes)]
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(hashes)))
        n_texts = np.add.reduceat(other.astype(np.int64), first) if len(first) else n
        return hashes[first].view(np.int64), n_texts, n

    counted = arrow_pass(texts, ["text", "digest"], "hash BIGINT, n_texts BIGINT, n BIGINT", step, 512)
    return counted.groupBy("hash").agg(F.sum("n_texts").alias("n_texts"), F.sum("n").alias("n"))


def suffix_tuples(
    texts: DataFrame, copied: np.ndarray, repeated: np.ndarray, hot: np.ndarray | None
) -> DataFrame:
    """hash, data of the tuples of repeated anchors. Those of hot anchors come with a null
    hash and one row per window, whose ``data`` is the window, then document, text, place."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((copied, repeated, hot))

    def step(ids, numbers, texts, digests):
        copied_flags, flags, hot_flags = sent.value
        chosen = taken(copied_flags, digests)
        ids, numbers, texts = ([column[i] for i in chosen] for column in (ids, numbers, texts))
        raw, starts, ends = laid_out(texts)
        text, hashes, places, low, high = find_anchors(raw, starts, ends)
        keep = passes(flags, hashes)
        text, hashes, places, low, high = (x[keep] for x in (text, hashes, places, low, high))
        made = np.zeros(len(text), _TUPLE)
        held = np.append(raw, np.zeros(WINDOW, np.uint8))
        steps = np.arange(WINDOW)
        inside = steps < (high + WINDOW - places)[:, None]
        made["after"] = np.where(inside, held[places[:, None] + steps], 0)
        steps = np.arange(BEFORE) + 1
        inside = steps <= (places - low)[:, None]
        made["before"] = np.where(inside, held[np.maximum(places[:, None] - steps, 0)], 0)
        made["doc_id"] = np.array(ids, np.int64)[text]
        made["text"], made["place"] = np.array(numbers, np.int64)[text], places - starts[text]
        made["first"], made["last"] = places - high, places - low
        if hot_flags is None:
            return hashes.view(np.int64), _binary(made)
        split = passes(hot_flags, hashes)
        rows = [t.tobytes() for t in made[~split]]
        windows = []
        for t in np.flatnonzero(split).tolist():
            tail = made["doc_id"][t].tobytes() + made["text"][t].tobytes()
            for w in range(low[t], high[t] + 1):
                windows.append(raw[w : w + WINDOW].tobytes() + tail + np.int64(w - starts[text[t]]).tobytes())
        return [*hashes[~split].view(np.int64).tolist(), *([None] * len(windows))], rows + windows

    return arrow_pass(texts, ["doc_id", "number", "text", "digest"], "hash BIGINT, data BINARY", step, 128)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())]
    )


def least_between(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest of values[left:right] for each pair of bounds, left < right."""
    table = [values]
    widest = int((right - left).max(initial=1))
    while 2 << (len(table) - 1) <= widest:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp((right - left).astype(float))[1] - 1
    least = np.zeros(len(left), values.dtype)
    for k, row in enumerate(table):
        at = np.flatnonzero(level == k)
        least[at] = np.minimum(row[left[at]], row[right[at] - (1 << k)])
    return least


def induced(group: np.ndarray, tuples: np.ndarray) -> np.ndarray:
    """Which windows of which tuples stand in a smaller document too: [tuple, step].

    ``tuples`` are in order of (group, bytes after the anchor). ``order`` holds the tuples
    sorted by the suffix ``step`` bytes before the anchor, ``common`` the length of the
    prefix each shares with the one before it in the same group, WINDOW at most.
    """
    flagged = np.zeros((len(tuples), BEFORE + 1), bool)
    after, doc_ids = tuples["after"], tuples["doc_id"]
    differs = after[1:] != after[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), WINDOW)
    common[group[1:] != group[:-1]] = 0
    common = np.append(0, common).astype(np.uint8)
    order = np.arange(len(tuples))
    largest = np.iinfo(np.int64).max
    for step in range(BEFORE + 1):
        own = tuples["first"][order] <= step
        starts = np.flatnonzero(common < WINDOW)
        sizes = np.diff(np.append(starts, len(order)))
        ids = np.where(own, doc_ids[order], largest)
        least = np.repeat(np.minimum.reduceat(ids, starts), sizes)
        flagged[order[own & (ids > least)], step] = True
        if step == BEFORE:
            break
        # one byte further: those whose windows reach it, sorted by that byte within
        # their group; the order among equal bytes is the one before
        live = np.flatnonzero(tuples["last"][order] > step)
        if not len(live):
            break
        key = group[order[live]].astype(np.int64) << 8 | tuples["before"][order[live], step]
        sort = np.argsort(key, kind="stable")
        ranks, key = live[sort], key[sort]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        shared = np.zeros(len(ranks), np.int64)
        shared[same] = 1 + least_between(common, ranks[same - 1] + 1, ranks[same] + 1).astype(np.int64)
        common = np.minimum(shared, WINDOW).astype(np.uint8)
        order = order[ranks]
    return flagged


def flagged_runs(tuples: np.ndarray, flagged: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, low, high: windows (by their first byte) to remove, in runs."""
    edges = np.diff(np.pad(flagged, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    rows, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    place = tuples["place"][rows]
    return tuples["text"][rows], place - end + 1, place - begin


def sorted_runs(tuples: DataFrame) -> DataFrame:
    """text, low, high of all tuples, group by group as the sort on disk brings them."""
    schema = arrow_schema(_RUNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block(hashes: np.ndarray, rows: np.ndarray):
            group = np.cumsum(np.append(0, hashes[1:] != hashes[:-1]))
            twice = (np.bincount(group) > 1)[group]  # hits of the filter alone go here
            group, rows = group[twice], rows[twice]
            if len(rows):
                made = flagged_runs(rows, induced(group, rows))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], schema=schema)

        def drained(last: bool):
            hashes, rows = (np.concatenate(x) for x in zip(*held))
            earlier = np.flatnonzero(hashes != hashes[-1])  # the last group may go on
            cut = len(hashes) if last else int(earlier[-1]) + 1 if len(earlier) else 0
            held[:] = [(hashes[cut:], rows[cut:])] if cut < len(hashes) else []
            if cut:
                yield from block(hashes[:cut], rows[:cut])

        for batch in batches:
            if not batch.num_rows:
                continue
            data = batch.column(1)
            offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
            raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            held.append((batch.column(0).to_numpy().copy(), raw.copy().view(_TUPLE)))
            if sum(len(h) for h, _ in held) >= BLOCK_TUPLES:
                yield from drained(False)
        if held:
            yield from drained(True)

    return tuples.repartition(F.col("hash")).sortWithinPartitions("hash", "data").mapInArrow(run, _RUNS)


def hot_runs(windows: DataFrame) -> DataFrame:
    """text, low, high of the windows of hot anchors. Equal windows meet as sums of their
    tasks first, so that one passage of many texts is no large group."""

    def step(rows):
        tail = np.frombuffer(b"".join(row[WINDOW:] for row in rows), np.int64).reshape(-1, 3)
        return [row[:WINDOW] for row in rows], tail[:, 0], tail[:, 1], tail[:, 2]

    cut = arrow_pass(
        windows, ["data"], "string BINARY, doc_id BIGINT, text BIGINT, low BIGINT", step, 8192
    )
    least = cut.groupBy("string").agg(F.min("doc_id").alias("least"))
    return cut.join(least, "string").where("doc_id > least").select("text", "low", F.col("low").alias("high"))


def kept_bytes(raw: bytes, lows: list[int], highs: list[int]) -> tuple[int, int, bytes]:
    """n_removed, n_spans and what is left of a text after its flagged windows go."""
    edges = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edges, np.array(lows, np.int64), 1)
    np.add.at(edges, np.array(highs, np.int64) + WINDOW, -1)
    gone = np.cumsum(edges)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, hot_tuples: int = HOT_TUPLES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the bytes left, null for
    a text of which all copies but the first are removed whole).

    Reads doc_id and text; other columns are ignored. A null text counts as empty. Copies
    of a whole text are told first by their digest: all but those of the smallest doc_id
    lose everything, if they have WINDOW bytes. Rows without doc_id keep all and are
    compared with nothing. Equal ids are not smaller than each other, so repeated rows
    have equal results.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id IS NOT NULL")
    keys = named.select(
        "doc_id",
        F.md5("text").alias("digest"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.when(F.octet_length("text") < WINDOW, F.sha2("text", 256)).alias("short_sha256"),
    )
    per_id = keys.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    copies = written(
        per_id.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.sum("n").alias("n"), F.min_by("n", "doc_id").alias("times"))
        .where("n > 1")
        .select("digest", "first_id", "times"),
        "copied-texts",
    )
    flags = bit_filter(copies.select(F.xxhash64("digest").alias("h")), "h", COPY_FILTER_BITS)
    copied = docs.sparkSession.sparkContext.broadcast(flags)
    single = named.select(
        "doc_id", "text", F.lit(1).cast("bigint").alias("times"), F.xxhash64(F.md5("text")).alias("digest")
    )

    def likely(ids, texts, digests):
        own = set(taken(copied.value, digests))
        rest = [i for i in range(len(ids)) if i not in own]
        return [ids[i] for i in rest], [texts[i] for i in rest]

    # what the filter hits: copied texts, of which the first is taken, and a few single ones
    firsts = written(
        arrow_pass(single, ["doc_id", "text", "digest"], "doc_id BIGINT, text STRING", likely)
        .withColumn("digest", F.md5("text"))
        .join(copies, "digest", "left")
        .where("first_id IS NULL OR doc_id = first_id")
        .groupBy("doc_id", "digest")
        .agg(F.first("text").alias("text"), F.max(F.coalesce("times", F.lit(1))).alias("times")),
        "first-texts",
    )
    named_firsts = firsts.select("doc_id", "text", "times", F.lit(None).cast("bigint").alias("digest"))
    texts = single.unionByName(named_firsts).withColumn("number", F.xxhash64("doc_id", "text"))

    counts = written(anchor_counts(texts, flags).where("n_texts > 1"), "repeated-anchors")
    repeated = bit_filter(counts, "hash", FILTER_BITS)
    many = counts.where(F.col("n") > hot_tuples)
    hot = None if many.isEmpty() else bit_filter(many, "hash", FILTER_BITS)
    tuples = suffix_tuples(texts, flags, repeated, hot)
    if hot is None:
        runs = sorted_runs(tuples)
    else:
        tuples = written(tuples, "suffix-tuples")
        runs = sorted_runs(tuples.where("hash IS NOT NULL")).unionByName(hot_runs(tuples.where("hash IS NULL")))
    of_text = (
        runs.withColumnRenamed("text", "number")
        .groupBy("number")
        .agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    )

    def finish(ids, texts, times, digests, lows, highs):
        made = []
        for i in taken(copied.value, digests):
            doc_id, text, n, low, high = ids[i], texts[i], times[i], lows[i], highs[i]
            raw = text.encode()
            removed, spans, kept = kept_bytes(raw, low, high) if low else (0, 0, raw)
            made += [(doc_id, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept)] * n
        return list(zip(*made)) or [[]] * 6

    columns = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, kept BINARY"
    first_rows = arrow_pass(
        texts.join(of_text, "number", "left"), ["doc_id", "text", "times", "digest", "lows", "highs"], columns, finish, 256
    )
    whole = F.col("n_bytes") >= WINDOW
    copy_rows = (
        keys.join(copies, "digest")
        .where("doc_id > first_id")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"),
            F.when(whole, 1).otherwise(0).cast("bigint").alias("n_spans"),
            F.coalesce("short_sha256", F.sha2(F.lit(""), 256)).alias("kept_sha256"),
            F.lit(None).cast("binary").alias("kept"),
        )
    )
    unnamed = rows.where("doc_id IS NULL").select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.col("text").cast("binary").alias("kept"),
    )
    return first_rows.unionByName(copy_rows).unionByName(unnamed)
