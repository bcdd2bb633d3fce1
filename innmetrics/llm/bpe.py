"""BPE encoding and decoding: speculate, verify, and merge exactly only where that fails.

A sequence of tokens is the encoding of its bytes exactly when every adjacent pair is:
the two tokens are what their joined bytes encode to. So a word is first cut by greedy
longest match; all adjacent pairs of all new words are then checked together with array
operations; words with a failing pair are merged pair by pair in rank order.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import regex
from pyspark.sql import DataFrame

from innmetrics.llm.common import arrow_pass

# Fixed value: how this kind of tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded words a task remembers; when so many are new, those not used since are dropped.
CACHE_WORDS = 250_000
#: Longer words are not remembered, and are merged one by one.
CACHE_WORD_CHARS = 64


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.vocab = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: token for token, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.reach: dict[bytes, int] = {}
        for token in self.vocab:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pairs = [(self.vocab[raw(a)], self.vocab[raw(b)]) for a, b in merges]
        made = [self.vocab[raw(a + b)] for a, b in merges]
        self.rank = {pair: (rank, token) for rank, (pair, token) in enumerate(zip(pairs, made))}

        # rank_of: when a token comes to be, with single bytes before all merges;
        # left and right: what it is merged from (itself for a byte).
        size = max(self.bytes_of) + 1
        self.rank_of = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        for rank, (pair, token) in enumerate(zip(pairs, made)):
            self.rank_of[token], self.left[token], self.right[token] = rank, *pair
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.made = np.array([*made, -1])
        self.byte_ids = np.array([self.vocab[bytes([b])] for b in range(256)])
        every = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_ranks = self.merge_rank(*every).reshape(256, 256)
        self.texts = [str(i).encode() for i in range(size)]
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.known: dict[str, tuple[int, bytes, bytes]] = {}
        self.earlier: dict[str, tuple[int, bytes, bytes]] = {}

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; beyond all ranks if there is none."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.pair_keys))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b, side by side, stay as they are.

        Undoes the merges inside both, the latest first, and looks each time at the two
        pieces that then touch: if they merge before the piece was built, they would have.
        At one rank the merge further left comes first.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        until = np.full(len(a), np.iinfo(np.int64).max)  # touching pieces exist before this time
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            # time 2r+1: the merge of rank r across the border; 2r+2 and 2r: the end of the
            # life of pieces left of it (merged first, at 2r) and right of it (after, 2r+2)
            across = 2 * self.merge_rank(x, y) + 1
            none = 2 * len(self.pair_keys)
            meet = (across < none) & (across < until[live])
            good[live[meet]] = False
            live = live[~meet]
            x, y = a[live], b[live]
            made_x, made_y = 2 * self.rank_of[x], 2 * self.rank_of[y] + 2
            made_x[self.rank_of[x] < 0] = -1
            made_y[self.rank_of[y] < 0] = -1
            more = (made_x >= 0) | (made_y >= 0)
            live, x, y, made_x, made_y = live[more], x[more], y[more], made_x[more], made_y[more]
            undo_x = made_x > made_y
            until[live] = np.where(undo_x, made_x, made_y)
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_x, y, self.left[y])
        return good

    def greedy(self, word: bytes) -> list[int]:
        ids, start, size = [], 0, len(word)
        vocab, reach = self.vocab, self.reach
        while start < size:
            end = start + reach.get(word[start : start + 2], 1)
            while (token := vocab.get(word[start:end])) is None:
                end -= 1
            ids.append(token)
            start = min(end, size)
        return ids

    def merged_together(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of many short words at once: in each round every word makes its
        merge of lowest rank, the leftmost first."""
        done: list[list[int]] = [[] for _ in words]
        raw = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words)), list(map(len, words)))
        none = len(self.pair_keys)
        ids = self.byte_ids[raw]
        ranks = np.full(len(ids), none)  # of each piece with the next one
        inner = owner[1:] == owner[:-1]
        ranks[:-1][inner] = self.byte_ranks[raw[:-1], raw[1:]][inner]
        while len(ids):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            final = lowest == none
            if final.any():
                held, names = ids[final], owner[final]
                cuts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
                for name, part in zip(names[cuts].tolist(), np.split(held, cuts[1:])):
                    done[name] = part.tolist()
                keep = ~final
                ids, owner, ranks, lowest = ids[keep], owner[keep], ranks[keep], lowest[keep]
                if not len(ids):
                    break
            at = np.flatnonzero(ranks == lowest)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
            ids[at] = self.made[ranks[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            for left in (at, at[at > 0] - 1):
                left = left[left < len(ids) - 1]
                same = owner[left] == owner[left + 1]
                ranks[left] = np.where(same, self.merge_rank(ids[left], ids[left + 1]), none)
            ranks[-1] = none
        return done

    def merged(self, word: bytes) -> list[int]:
        """Merging by rank, the leftmost first: a heap over a linked list of pieces."""
        from heapq import heapify, heappop, heappush

        ids = [self.vocab[bytes([b])] for b in word]
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        rank = self.rank
        heap = [
            (r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None
        ]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = rank[a, b][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := rank.get((ids[k], ids[after[k]]))) is not None:
                    heappush(heap, (r[0], k, ids[k], ids[after[k]]))
        return [token for token in ids if token >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, by speculation and verification."""
        raws = [w.encode() for w in words]
        guesses = [self.greedy(raw) for raw in raws]
        sizes = np.array([len(g) for g in guesses], np.int64)
        flat = np.fromiter((t for g in guesses for t in g), np.int64, count=int(sizes.sum()))
        if len(flat) < 2:
            return guesses
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = owner[1:] == owner[:-1]
        pairs, places = np.unique((flat[:-1] << 32 | flat[1:])[inner], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        failing = np.unique(owner[1:][inner][~good[places]]).tolist()
        short = [i for i in failing if len(raws[i]) <= CACHE_WORD_CHARS]
        for i, ids in zip(short, self.merged_together([raws[i] for i in short])):
            guesses[i] = ids
        for i in failing:
            if len(raws[i]) > CACHE_WORD_CHARS:
                guesses[i] = self.merged(raws[i])
        return guesses

    def learn(self, split: list[list[str]]) -> set[str]:
        """Has number of ids, ids as text and decoded bytes of all words in ``known``;
        returns the words that were not there."""
        if len(self.known) > CACHE_WORDS:
            self.earlier, self.known = self.known, {}
        new: set[str] = set()
        for words in split:
            new.update(filterfalse(self.known.__contains__, words))
        back = [w for w in new if w in self.earlier]
        self.known.update((w, self.earlier[w]) for w in back)
        rest = list(new.difference(back))
        own = [w for w in rest if w not in self.special]
        made = zip(own, self.encode_words(own))
        texts = self.texts
        for word, ids in chain(made, ((w, [self.special[w]]) for w in rest if w in self.special)):
            self.known[word] = len(ids), b",".join([texts[i] for i in ids]), self.decode_bytes(ids)
        return new

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text."""
        if self.marks is None or not any(content in text for content in self.special):
            return self.words.findall(text)
        words: list[str] = []
        for part in self.marks.split(text):
            words += [part] if part in self.special else self.words.findall(part)
        return words

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        plain = [w for w in words if w not in self.special]
        made = dict(zip(plain, self.encode_words(plain)))
        return [i for w in words for i in ([self.special[w]] if w in self.special else made[w])]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, ids: the token ids of every whole text.

    ``vocabulary`` names a public file or gives a path that every executor can open.
    Reads doc_id and text. A null text counts as empty and has no ids. Text that spells a
    special token becomes that token. Repeated rows give repeated results.
    """

    def step(ids, texts):
        own = _codec(vocabulary)
        return ids, [own.encode(text or "") for text in texts]

    return arrow_pass(docs, ["doc_id", "text"], "doc_id BIGINT, ids ARRAY<INT>", step, 128)


def decode_documents(rows: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give an empty text."""

    def step(doc_ids, ids):
        own = _codec(vocabulary)
        return doc_ids, [own.decode(i or []) for i in ids]

    return arrow_pass(rows, ["doc_id", "ids"], "doc_id BIGINT, text STRING", step, 128)


def digest_documents(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", carried: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the columns ``carried`` (strings), n_tokens, ids_sha256 and decoded_sha256
    of every whole text, without moving the ids; same rules as ``encode_documents``."""

    def step(texts, doc_ids, *others):
        own = _codec(vocabulary)
        split = [own.split(text) if text else [] for text in texts]
        new, known, rows = own.learn(split), own.known, []
        for doc_id, words in zip(doc_ids, split):
            sizes, ids, raws = zip(*map(known.__getitem__, words)) if words else ((), (), ())
            decoded = b"".join(raws).decode("utf-8", errors="replace").encode()
            rows.append((doc_id, sum(sizes), _sha(b",".join(ids)), _sha(decoded)))
        for word in new:
            if len(word) > CACHE_WORD_CHARS:
                del known[word]
        made = list(zip(*rows)) or [[]] * 4
        return [made[0], *others, *made[1:]]

    names = "".join(f"{c} STRING, " for c in carried)
    return arrow_pass(
        docs,
        ["text", "doc_id", *carried],
        f"doc_id BIGINT, {names}n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING",
        step,
        256,
    )


def _codec(vocabulary: str) -> Codec:
    return codec(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary))


def _sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
