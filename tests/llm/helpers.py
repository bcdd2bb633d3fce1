"""Small documents with every odd case, and plain versions of the operators."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, words STRING, hash INT"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a strong potion near the old mill"


def frame(spark, texts, langs=None):
    """Documents from (doc_id, text) with extra columns of names that operators use."""
    rows = [
        (i, t, (langs or {}).get(i, "en"), "s", None if t is None else len(t), "extra", 1) for i, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, PROSE),
    (4, PROSE),
    (5, PROSE),
    (6, PROSE.upper()),
    (None, PROSE),
    (7, "é中😀 <|endoftext|> don't  stop\r\n\n###"),
    (8, ("word soup number " * 4000) + "end"),
    (9, "x"),
]


def rows_of(made):
    return Counter(tuple(r) for r in made.collect())


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs):
    prints = [brute_fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return Counter(
        (doc_id, f"{prints[i]:016x}", min(least[root(i)], default=None)) for i, (doc_id, _) in enumerate(docs)
    )


def brute_repeats(docs, size=50):
    first = {}
    for doc_id, text in docs:
        raw = (text or "").encode()
        for p in range(len(raw) - size + 1) if doc_id is not None else ():
            first[raw[p : p + size]] = min(first.get(raw[p : p + size], doc_id), doc_id)
    found = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - size + 1) if doc_id is not None else ():
            if first[raw[p : p + size]] < doc_id:
                gone[p : p + size] = [True] * size
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        found.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


def brute_rule_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )
