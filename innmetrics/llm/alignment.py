"""Cross-tokenizer alignment by interval coalescing.

The tokens of two tokenizers are byte intervals of one text. All intervals are sorted by
start, a running maximum of their ends is kept, and a group ends where the next start
reaches that maximum. Within groups every pair of overlapping tokens is a link.

Neither tokenizer joins what comes before a space with the space, so a text falls into
units, from a space up to the next one, that are encoded alike wherever they stand. Each
different unit of a block of documents is aligned once, many together in arrays; documents
are sums over their units. How often two token ids are linked is counted over all blocks
by Spark, and each block gets the counts of its own pairs back.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.llm.bpe import WORDS, Codec, vocabulary_path
from innmetrics.llm.common import arrow_pass, arrow_schema, written

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text after which a block is closed; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Units that a task remembers, and the bytes of their groups as text.
CACHE_UNITS, CACHE_BYTES = 150_000, 16 << 20

#: A space that can't be cut off what is before it.
_TIED = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def units(text: str) -> list[str]:
    """The units of a space and the text, each without the space it starts with. A last
    space stays with the unit before it, since nothing follows that could be encoded."""
    if _TIED.search(" " + text):
        found = [unit[1:] for unit in _CUT.split(" " + text)]
    else:
        found = text.split(" ")
    if len(found) > 1 and found[-1] == "":
        found[-2:] = [found[-2] + " "]
    return found


def flat(lists: list[list[int]]) -> np.ndarray:
    return np.array(list(chain.from_iterable(lists)), np.int64)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum over each of the runs, of the given sizes, that the values fall into."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges from each start, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Aligner:
    """Two vocabularies, byte-level BPE (a) and sentence pieces (b), which add a space; and
    the units aligned so far, as arrays: tokens of either side, groups, links."""

    def __init__(self, a: str, b: str):
        spec = Codec(a)
        ids = [spec.made[rank] for rank in range(len(spec.made) - 1)]
        if ids != sorted(ids):
            raise ValueError("the ids of the byte-level vocabulary must follow its merges")
        special = set(spec.special.values())
        ranks = {raw: i for raw, i in spec.vocab.items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.b_size = self.b.get_piece_size()
        self.b_bytes = [self._piece(i) for i in range(self.b_size)]
        a_bytes = [spec.bytes_of.get(i, b"") for i in range(max(spec.bytes_of) + 1)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, raws))) for raws in (a_bytes, self.b_bytes))
        if any(re.search(rb"[^ ] ", piece) for piece in self.b_bytes):
            raise ValueError("pieces go beyond a space: texts can't be cut there")
        self.names = np.array([str(i) for i in range(max(len(a_bytes), self.b_size))], object)
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.valid = np.zeros(0, bool)
        self.n_a, self.n_b, self.n_groups, self.n_links, self.pairs = (np.zeros(0, np.int64) for _ in range(5))
        self.spelled: list[bytes] = []

    def link_starts(self) -> np.ndarray:
        return np.cumsum(self.n_links) - self.n_links

    def learn(self, units: list[str]) -> np.ndarray:
        """The place of each unit in the arrays; units are different."""
        if len(self.known) > CACHE_UNITS or self.size > CACHE_BYTES:
            self.forget()
        new = [unit for unit in units if unit not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            made = self.align(new)
            for name, values in zip(("valid", "n_a", "n_b", "n_groups", "n_links", "pairs"), made):
                setattr(self, name, np.concatenate([getattr(self, name), values]))
            self.spelled += made[-1]
            self.size += sum(map(len, made[-1]))
        return np.fromiter(map(self.known.__getitem__, units), np.int64, count=len(units))

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a and b, unit by unit, and which units b gives back; a always does.

        Units that another may follow are encoded many at a time, as texts.
        """
        ok = np.array(["▁" not in unit for unit in units], bool)
        while True:
            good = [unit for unit, fine in zip(units, ok) if fine]
            texts = _texts(good)
            b = self.b.encode(texts, num_threads=1)
            if b"".join([b"".join([self.b_bytes[i] for i in ids]) for ids in b]) == "".join([" " + t for t in texts]).encode():
                a = [self.a.encode_ordinary(" " + text) for text in texts]
                return flat(a), flat(b), ok
            again = self.b.encode(good, num_threads=1)
            raws = [b"".join([self.b_bytes[i] for i in ids]) for ids in again]
            ok[ok] = [raw == (" " + unit).encode() for raw, unit in zip(raws, good)]

    def align(self, units: list[str]) -> tuple:
        """valid, n_a, n_b, n_groups, n_links, the linked pairs and the groups as text."""
        units, back = _safe_first(units)
        a, b, ok = self.encode(units)
        sizes = np.array([len(unit.encode()) + 1 for unit in units]) * ok
        limits = np.cumsum(sizes)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_start, b_start = a_end - self.a_sizes[a], b_end - self.b_sizes[b]

        # coalesce: a group breaks where a start reaches the running maximum of the ends
        starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        order = np.lexsort((ends, starts))
        reach = np.maximum.accumulate(ends[order])
        breaks = starts[order][1:] >= reach[:-1]
        group = np.zeros(len(order), np.int64)
        group[order[1:]] = np.cumsum(breaks)
        unit = np.searchsorted(limits, starts, side="right")
        firsts = order[np.flatnonzero(np.concatenate([[True], breaks])[: len(order)])]
        count = lambda owners: np.bincount(owners, minlength=len(units))

        # within the groups: the b tokens that each a token overlaps
        low = np.searchsorted(b_end, a_start, side="right")
        met = np.searchsorted(b_start, a_end, side="left") - low
        pairs = np.repeat(a, met) * self.b_size + b[expanded(low, met)]
        n_links = np.bincount(unit[: len(a)], met, len(units)).astype(np.int64)

        spelled = iter(self._spelled(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), starts, group, unit))
        texts = [next(spelled) if fine else b"" for fine in ok.tolist()]
        own = (ok, count(unit[: len(a)]), count(unit[len(a) :]), count(unit[firsts]), n_links)
        links = pairs[expanded((np.cumsum(n_links) - n_links)[back], n_links[back])]
        return (*[values[back] for values in own], links, [texts[i] for i in back.tolist()])

    def _spelled(self, ids, side, starts, group, unit) -> list[bytes]:
        """a1,a2|b1;a3|b2,b3 of each unit that has tokens."""
        if not len(ids):
            return []
        order = np.lexsort((starts, side, group))
        side, group, unit = side[order], group[order], unit[order]
        mark = np.zeros(len(order), np.int64)
        mark[:-1] = np.select([unit[1:] != unit[:-1], group[1:] != group[:-1], side[1:] != side[:-1]], [0, 1, 2], 3)
        both = np.empty(2 * len(order), object)
        both[::2], both[1::2] = self.names[ids[order]], np.array(["\n", ";", "|", ","], object)[mark]
        return "".join(both.tolist()).encode().split(b"\n")[:-1]


def _safe(unit: str) -> bool:
    """Whether another unit may follow: it ends in a character other than white space."""
    return unit != "" and not unit[-1].isspace()


def _safe_first(units: list[str]) -> tuple[list[str], np.ndarray]:
    """The units with those that nothing may follow last, and where each one went."""
    last = np.array([not _safe(unit) for unit in units], bool)
    order = np.argsort(last, kind="stable")
    back = np.empty(len(units), np.int64)
    back[order] = np.arange(len(units))
    return [units[i] for i in order.tolist()], back


def _texts(units: list[str], together: int = 200) -> list[str]:
    """Texts that the units fall out of again: safe ones, which come first, joined."""
    safe = sum(map(_safe, units))
    return [" ".join(units[i : min(i + together, safe)]) for i in range(0, safe, together)] + units[safe:]


@lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(*[name if "/" in name else vocabulary_path(name) for name in (a, b)])


def narrow(values: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest bytes, of which the first tells how many each has."""
    size = 2 if not len(values) or values.max() < 1 << 16 else 4
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def widened(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


_BLOCK = (
    "block BIGINT, doc_ids ARRAY<BIGINT>, n_a ARRAY<BIGINT>, n_b ARRAY<BIGINT>, n_groups ARRAY<BIGINT>, "
    "n_links ARRAY<BIGINT>, digests ARRAY<STRING>, n_units BINARY, units BINARY, unit_links BINARY, links BINARY, "
    "pairs ARRAY<BIGINT>, counts ARRAY<BIGINT>"
)


def block_row(own: Aligner, number: int, ids: list, texts: list) -> tuple:
    """One block: per document its sums and digest, and its units; per unit its links, as
    places in the block's different pairs; per pair how often it is linked in the block."""
    place: dict[str, int] = {}
    seen = lambda text: np.fromiter(
        (place.setdefault(unit, len(place)) for unit in units(text)), np.int64
    )
    parts = [seen(text) if text else np.zeros(0, np.int64) for text in texts]
    found = own.learn(list(place))
    valid = own.valid[found]
    parts = [part if valid[part].all() else part[:0] for part in parts]
    spelled = [own.spelled[i] for i in found.tolist()]
    digests = [sha256(b";".join([spelled[i] for i in part.tolist()])).hexdigest() if len(part) else "" for part in parts]
    sizes = np.array(list(map(len, parts)), np.int64)
    used = np.concatenate([np.zeros(0, np.int64), *parts])
    per_doc = [sums(values[found][used], sizes) for values in (own.n_a, own.n_b, own.n_groups, own.n_links)]
    unit_links = own.n_links[found]
    every = own.pairs[expanded(own.link_starts()[found], unit_links)]
    pairs, links = np.unique(every, return_inverse=True)
    times = np.repeat(np.bincount(used, minlength=len(found)), unit_links)
    counts = np.bincount(links, times, len(pairs)).astype(np.int64)
    packed = [narrow(sizes), narrow(used), narrow(unit_links), narrow(links)]
    return (number, ids, *[x.tolist() for x in per_doc], digests, *packed, pairs, counts)


def blocks(docs: DataFrame, a: str, b: str, block_bytes: int) -> DataFrame:
    """Documents in the order they are stored, one row per block."""
    schema = arrow_schema(_BLOCK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(a, b), TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0)), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + block_bytes, side="right")))
                part = batch.slice(start, stop - start)
                row = block_row(own, number, part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                start, number = stop, number + 1

    return docs.select("doc_id", "text").mapInArrow(run, _BLOCK)


def pair_counts(pairs: DataFrame, b_size: int) -> DataFrame:
    """pair, total, best: how often two ids are linked in the whole table, and whether no
    other id is linked more often to the same b."""
    totals = pairs.groupBy("pair").agg(F.sum("count").alias("total"))
    most = F.max("total").over(Window.partitionBy(F.col("pair") % b_size))  # as many rows as a has ids, at most
    return totals.select("pair", "total", (F.col("total") == most).alias("best"))


_RESULT = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, "
    "groups_sha256 STRING"
)


def align_documents(
    docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text.

    Vocabularies are public files by name, or paths that every executor can open. Reads
    doc_id and text; other columns are ignored. Null and empty texts, and those that a
    tokenizer doesn't give back byte by byte, have no tokens: zeros and an empty digest.
    Pairs with equal counts are all the best of their b. Every row of the input gives one,
    also where rows repeat. Long texts are a block of their own.
    """
    made = written(blocks(docs, a, b, block_bytes), "alignment-blocks")
    pairs = made.select("block", F.inline(F.arrays_zip("pairs", "counts"))).toDF("block", "pair", "count").where("count > 0")
    totals = pair_counts(pairs, aligner(a, b).b_size)
    known = pairs.select("block", "pair").join(totals, "pair").select("block", "pair", "total", "best")

    def finish(key, own: pa.Table, counted: pa.Table) -> pa.Table:
        row = {name: own.column(name)[0] for name in own.column_names}
        pairs = np.array(row["pairs"].values, np.int64)
        at = np.searchsorted(pairs, np.array(counted.column("pair"), np.int64))
        totals, best = np.zeros((2, len(pairs)), np.int64)
        totals[at], best[at] = np.array(counted.column("total")), np.array(counted.column("best"))
        sizes, used, unit_links, links = [widened(row[c].as_py()) for c in ("n_units", "units", "unit_links", "links")]
        n_best, count_sum = [sums(sums(values[links], unit_links)[used], sizes) for values in (best, totals)]
        plain = [row[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_arrays(
            [*plain, pa.array(n_best), pa.array(count_sum), row["digests"].values], schema=arrow_schema(_RESULT)
        )

    return made.drop("counts").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(finish, _RESULT)


def aligned_groups(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> DataFrame:
    """doc_id, groups: the groups themselves, as a1,a2|b1;a3|b2,b3 in ids; same rules."""
    def step(ids, texts):
        own, made = aligner(a, b), []
        for text in texts:
            own_units = units(text) if text else []
            place = dict(zip(own_units, range(len(own_units))))
            at = dict(zip(place, own.learn(list(place)).tolist()))
            whole = own_units and all(own.valid[i] for i in at.values())
            made.append(b";".join([own.spelled[at[unit]] for unit in own_units]).decode() if whole else "")
        return ids, made

    return arrow_pass(docs, ["doc_id", "text"], "doc_id BIGINT, groups STRING", step, 128)
