"""Cross-tokenizer alignment against the two libraries and plain loops."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, frame, rows_of
from tokenizers import Tokenizer

from innmetrics.llm import alignment
from innmetrics.llm.bpe import byte_letters

LETTERS = list("abcdefghij   \n\t'stREllé ñ中😀  0123.,!#-_=▁　\x00\x1c\x85") + [
    "<|endoftext|>", "<s>", "the", "ing", "    ", "====", "\r\n", " 's", " the",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(libraries, text):
    """(id, start, end) of both sides, or two empty lists."""
    a, b = libraries
    letters, raw = byte_letters(), (" " + (text or "")).encode()
    a_ids, b_ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], []
    sides = []
    for ids, parts in ((a_ids, a_bytes), (b_ids, b_bytes)):
        end, side = 0, []
        for i, part in zip(ids, parts):
            side.append((i, end, end := end + len(part)))
        sides.append(side)
    return sides


def brute(libraries, docs):
    aligned, counts = [], Counter()
    for doc_id, text in docs:
        a, b = tokens(libraries, text)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for cut in cuts:
            within = [",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(within))
            start = cut
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    found = Counter()
    for doc_id, n_a, n_b, groups, links in aligned:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(counts[link] == best[link[1]] for link in links)
        found[doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[link] for link in links), digest] += 1
    return found


def documents():
    rnd = random.Random(12)
    docs = [(i, t if t is None else t[:400]) for i, t in ODD]
    docs += [(i, "".join(rnd.choices(LETTERS, k=rnd.randint(1, 40)))) for i in range(100, 900)]
    ends = [" ", "  ", "x ", " x", "a\n b", "a \n", "\n", "▁", "a▁ b", "é" * 200, "中文字" * 30]
    return docs + [(1000 + i, text) for i, text in enumerate(ends)]


def test_alignment_equals_the_plain_one(spark, libraries):
    docs = documents()
    expected = brute(libraries, docs)
    assert sum(key[1] == 0 for key in expected) > 100  # some texts don't come back byte by byte
    assert rows_of(alignment.align_documents(frame(spark, docs))) == expected
    assert rows_of(alignment.align_documents(frame(spark, docs).repartition(5), block_bytes=200)) == expected


def test_groups_are_given_as_text(spark, libraries):
    docs = documents()
    texts = {r.doc_id: r.groups for r in alignment.aligned_groups(frame(spark, docs)).collect()}
    for key in brute(libraries, [d for d in docs if d[0] != 4]):
        text = texts[key[0]]
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == key[-1]


def test_units_are_encoded_as_in_the_whole_text(libraries):
    a, b = libraries
    rnd, own = random.Random(4), alignment.Aligner(*map(public_tokenizers.path, (alignment.A_VOCABULARY, alignment.B_VOCABULARY)))
    for _ in range(500):
        text = "".join(rnd.choices([c for c in LETTERS if c != "▁"], k=60))
        units = alignment.units(text)
        assert " " + " ".join(units) == " " + text
        ids = [own.encode([unit]) for unit in units]
        assert [i for x in ids for i in x[0]] == a.encode(" " + text, add_special_tokens=False).ids
        if all(x[2][0] for x in ids):  # else b changes a character
            assert [i for x in ids for i in x[1]] == b.encode(text)


def test_forgetting_changes_nothing(libraries, monkeypatch):
    texts = [text for _, text in documents()]
    own = alignment.Aligner(*map(public_tokenizers.path, (alignment.A_VOCABULARY, alignment.B_VOCABULARY)))
    whole = alignment.block_row(own, 0, list(range(len(texts))), texts)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 50)
    parts = [alignment.block_row(own, 0, [i], [text]) for i, text in enumerate(texts)]
    assert [value for part in parts for value in part[6]] == whole[6]
    assert [value for part in parts for value in part[5]] == whole[5]


def test_long_texts_and_no_documents(spark):
    long = "the quick,  brown fox " * 40000
    docs = frame(spark, [(1, long), (2, "the"), (3, "a" * 200_000)])
    made = {r.doc_id: r for r in alignment.align_documents(docs, block_bytes=1000).collect()}
    assert made[1].n_groups > 200_000 and made[2].n_groups == 1 and made[3].n_a > 0
    assert alignment.align_documents(docs.limit(0)).count() == 0
