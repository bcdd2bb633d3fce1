"""The Merkle manifest against a plain version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import ODD, PROSE, frame, rows_of
from pyspark.sql import functions as F

from innmetrics.llm import merkle
from innmetrics.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in doc))


def climb(nodes):
    """Root of a list of digests and for each of them its siblings, level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    paths = []
    for place in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            start = place - place % 3
            path.append((level[start:place], level[place + 1 : start + 3]))
            place //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute_audit(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    order = lambda d: (d[0] is not None, d[0] or 0, leaf(d))
    trees = defaultdict(list)
    for doc in docs:
        trees[doc[1]].append(doc)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {name: climb([leaf(d) for d in sorted(trees[name], key=order)]) for name in names}
    root, upper = climb([made[name][0] for name in names])
    found = Counter()
    for name, above in zip(names, upper):
        subroot, paths = made[name]
        for doc, path in zip(sorted(trees[name], key=order), paths):
            text = doc[4]
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf((*doc[:4], text))
            for left, right in path + above:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(s for left, right in path + above for s in left + right))
            found[(doc[0], leaf(doc), subroot, root, proof, folded, folded == root)] += 1
    return found


COLUMNS = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, leaf STRING, rank INT"


def audited(spark, tmp_path, docs):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(*d, "extra", 1) for d in docs], COLUMNS).write.mode("overwrite").parquet(path)
    return rows_of(QUERIES["op13_merkle_manifest"](spark, str(tmp_path)))


def odd_documents():
    rnd = random.Random(13)
    docs = [(i, "big", "en", None, f"line {i}\nsecond") for i in rnd.sample(range(-3000, 30000), 800)]
    docs += [(i * 2**40 + 7, None, None, 3, None if i % 3 else "") for i in range(-40, 40)]
    docs += [(i, f"s{i % 30}é", "é", i, "text " * i) for i in range(60)]
    docs += [(1, "one", "en", 1, PROSE)]
    docs += [(5, "same", "en", 1, f"other {i % 7}\n") for i in range(300)]  # repeated ids and rows
    docs += [(None, "same", "en", 1, f"no id {i % 40}\n") for i in range(120)]
    docs += [(2**63 - 1, "same", "", 1, "\n\n"), (-(2**63), "same", "", 1, "\n"), (63, "same", "", 1, "a"), (64, "same", "", 1, "b")]
    rnd.shuffle(docs)
    return docs


def test_manifest_equals_the_plain_one(spark, tmp_path):
    docs = odd_documents()
    assert audited(spark, tmp_path, docs) == brute_audit(docs)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 243, 244])
def test_manifest_of_few_leaves(spark, tmp_path, count):
    docs = [(i, "s", "en", i, "a\nb") for i in range(count)]
    assert audited(spark, tmp_path, docs) == brute_audit(docs)


def test_three_rounds_of_slot_arrays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 4)
    docs = odd_documents()[:150] + [(5, "same", "en", 1, PROSE)] * 9
    made = merkle.proofs(spark.createDataFrame(docs, COLUMNS.split(", leaf")[0]), depth=1)
    expected = Counter((k[0], k[1], k[2], k[3]) for k in brute_audit(docs).elements())
    rows = made.collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root) for r in rows) == expected
    assert all(merkle.fold(r.leaf, r.lefts, r.rights) == r.root for r in rows)


def test_manifest_of_odd_and_no_documents(spark):
    docs = frame(spark, ODD)
    made = merkle.audit(docs, F.col("text")).collect()
    assert len(made) == len(ODD) and all(r.verified and r.folded_root == r.root for r in made)
    assert merkle.audit(docs.limit(0), F.col("text")).count() == 0
