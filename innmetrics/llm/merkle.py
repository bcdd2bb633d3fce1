"""Merkle manifest of a dataset: leaf coordinates by bitmap ranks, levels in slot arrays.

Every source has a tree over its documents in the order of their ids, and the sources'
roots are the leaves of one more tree. No sort of documents gives that order: each source
keeps a bitmap of its ids, stored as its non-empty words of 64 ids and merged by OR from
every task, with a popcount directory of three levels above the words. The rank of an id
is what the directory counts before its word plus the bits before its own.

Rank div 243 and rank mod 243 are then the key and the slot of a leaf. The digests of a
key make one slot array, a complete subtree of five levels, so a round reduces the nodes
243 times. Proofs come down the same arrays, round by round.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.llm.common import arrow_pass, numbered, written

#: Nodes that are hashed together.
ARITY = 3
#: Levels of one slot array, which has 243 leaves then.
DEPTH = 5
#: Ids of a bitmap word are told apart by 6 bits, words of a directory entry by 16.
WORD_BITS, DIRECTORY_BITS = 6, 16
#: Word of rows without an id; those of real ids lie between -2**57 and 2**57.
NO_ID = -(2**58)
#: Hex digits by which different rows of one id are spread before they are ordered.
SPREAD_DIGITS = 3
#: Equal rows that one task writes out at a time.
COPIES = 10_000

_BEFORE = (Window.unboundedPreceding, -1)


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def tree_of(source: Column) -> Column:
    """Never null; in the order of sources, null first."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values one after another, each with its length in bytes before it."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """tree, doc_id, word, bit, leaf, changed (the leaf with ``presented`` in place of the
    text, null where that changes nothing)."""
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.lit(None).cast("string")
    if presented is not None:
        changed = F.when(~presented.eqNullSafe(F.col("text")), leaf_digest(*others, presented))
    return docs.select(
        tree_of(F.col("source")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.shiftright(F.col("doc_id").cast("bigint"), WORD_BITS), F.lit(NO_ID)).alias("word"),
        F.coalesce(F.col("doc_id").cast("bigint").bitwiseAND(F.lit(2**WORD_BITS - 1)), F.lit(0)).cast("int").alias("bit"),
        leaf_digest(*others, F.col("text")).alias("leaf"),
        changed.alias("changed"),
    )


def bitmap_words(rows: DataFrame) -> DataFrame:
    """tree, word, bits, n: the non-empty words of every tree's bitmap of ids and the rows
    that fall on each. Every task merges its own rows before the shuffle."""
    return rows.groupBy("tree", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.count("*").alias("n")
    )


def directory(words: DataFrame) -> DataFrame:
    """Adds base, the rows in earlier words of the tree, and total, all rows of the tree.

    Counts are added up over 2**16 words, entries of those and so on, and running totals
    are taken within each entry only, so no window holds more than 2**16 rows, however
    large a tree or scattered its ids.
    """
    up = lambda i: F.shiftright(F.col(f"w{i}"), DIRECTORY_BITS).alias(f"w{i + 1}")
    levels = [words.withColumnRenamed("word", "w0").select("*", up(0))]
    for i in (1, 2, 3):
        sums = levels[-1].groupBy("tree", f"w{i}").agg(F.sum("n").alias("n"))
        levels.append(sums.select("*", up(i)))
    earlier = lambda keys, order: F.coalesce(
        F.sum("n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(*_BEFORE)), F.lit(0)
    )
    above = levels[3].select(
        "tree", "w3", earlier(["tree"], "w3").alias("base"), F.sum("n").over(Window.partitionBy("tree")).alias("total")
    )
    for i in (2, 1, 0):
        own = levels[i].withColumn("inner", earlier(["tree", f"w{i + 1}"], f"w{i}"))
        base = (F.col("base") + F.col("inner")).alias("base")
        kept = ["bits", "n"] if i == 0 else []
        above = own.join(above, ["tree", f"w{i + 1}"]).select("tree", f"w{i}", *kept, base, "total")
    return above.withColumnRenamed("w0", "word")


def coordinates(rows: DataFrame) -> DataFrame:
    """tree, rank, total, doc_id, leaf, changed: the place of every leaf in its tree.

    Leaves ascend by doc_id, rows without one first; rows of one id by their digest, and
    equal rows take places side by side.
    """
    words = written(directory(written(bitmap_words(rows), "merkle-words")), "merkle-directory")
    crowded = F.col("n") > F.bit_count("bits")
    bits_before = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    columns = ["tree", "rank", "total", "doc_id", "leaf", "changed"]
    placed = (
        rows.join(words.where(~crowded), ["tree", "word"]).withColumn("rank", F.col("base") + bits_before).select(*columns)
    )
    again = words.where(crowded).drop("n", "bits")
    if again.isEmpty():
        return placed
    return placed.unionByName(_places_of_repeated_ids(rows, again).select(*columns))


def _places_of_repeated_ids(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The same for words that hold an id more than once. Equal rows are counted first;
    different ones of an id are spread by the first digits of their digest, and those
    cells are counted before any order within them is looked at."""
    cell = ["tree", "word", "bit", "cell"]
    different = (
        rows.join(words, ["tree", "word"])
        .groupBy("tree", "word", "base", "total", "doc_id", "bit", "leaf", "changed")
        .agg(F.count("*").alias("copies"))
        .withColumn("cell", F.substring("leaf", 1, SPREAD_DIGITS))
    )
    different = written(different, "merkle-repeated")
    order = Window.partitionBy("tree", "word").orderBy("bit", "cell").rowsBetween(*_BEFORE)
    cells = different.groupBy(*cell).agg(F.sum("copies").alias("n"))
    cells = cells.select(*cell, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    inner = F.sum("copies").over(Window.partitionBy(*cell).orderBy("leaf").rowsBetween(*_BEFORE))
    first = different.withColumn("inner", F.coalesce(inner, F.lit(0))).join(cells, cell)
    first = first.withColumn("first", F.col("base") + F.col("before") + F.col("inner"))
    pieces = first.withColumn("piece", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    numbers = f"sequence(piece * {COPIES}, least(copies, (piece + 1) * {COPIES}) - 1)"
    dealt = pieces.repartition("tree", "doc_id", "leaf", "piece")
    return dealt.withColumn("copy", F.explode(F.expr(numbers))).withColumn("rank", F.col("first") + F.col("copy"))


def slot_arrays(nodes: DataFrame, carried: tuple[str, ...], depth: int) -> DataFrame:
    """tree, total, block, slots, digests and the carried columns as arrays: at most
    ARITY**depth nodes (tree, rank, total, digest) in one row."""
    size = ARITY**depth
    slot = (F.col("rank") % size).cast("int").alias("slot")
    entry = F.collect_list(F.struct(slot, "digest", *carried)).alias("nodes")
    block = F.expr(f"rank div {size}").alias("block")
    rows = nodes.groupBy("tree", "total", block).agg(entry)
    arrays = [F.col("nodes.slot").alias("slots"), F.col("nodes.digest").alias("digests")]
    return rows.select("tree", "total", "block", *arrays, *[F.col(f"nodes.{c}").alias(c) for c in carried])


def height(total: int, depth: int) -> int:
    """Levels that a slot array of a tree of so many nodes is reduced by."""
    levels = 0
    while total > 1 and levels < depth:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def reduced(slots: list[int], digests: list[str], total: int, depth: int) -> list[list[str]]:
    """All levels of a slot array, from its nodes in the order of slots to the last one."""
    nodes = [""] * len(slots)
    for slot, value in zip(slots, digests):
        nodes[slot] = value
    levels = [nodes]
    for _ in range(height(total, depth)):
        nodes = [digest(*nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
        levels.append(nodes)
    return levels


def beside(levels: list[list[str]], slot: int) -> tuple[list[str], list[str]]:
    """For each level below the top what stands left and right of the node in its run."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        start = slot - slot % ARITY
        lefts.append("".join(nodes[start:slot]))
        rights.append("".join(nodes[slot + 1 : start + ARITY]))
        slot //= ARITY
    return lefts, rights


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights):
        leaf = digest(left, leaf, right)
    return leaf


def grow(nodes: DataFrame, carried: tuple[str, ...], depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of every round from the leaves up, and tree, digest of the roots."""

    def reduce(trees, blocks, totals, slots, digests):
        tops = [reduced(s, d, t, depth)[-1][0] for s, d, t in zip(slots, digests, totals)]
        return trees, blocks, [-(-t // ARITY**depth) for t in totals], tops

    rounds, roots = [], None
    while True:
        rounds.append(written(slot_arrays(nodes, carried, depth), "merkle-blocks"))
        tops = arrow_pass(
            rounds[-1],
            ["tree", "block", "total", "slots", "digests"],
            "tree STRING, rank BIGINT, total BIGINT, digest STRING",
            reduce,
            128,
        )
        tops = written(tops, "merkle-tops")
        done = tops.where("total = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        nodes, carried = tops.where("total > 1"), ()
        if nodes.isEmpty():
            return rounds, roots


_PATH = ("lefts", "rights", "subroot", "root")


def with_paths(rounds: list[DataFrame], above: DataFrame, depth: int) -> DataFrame:
    """The slot arrays of the first round with what lies beside the way up from each one
    (lefts, rights) and the columns subroot and root. ``above`` has those of every tree."""

    def descend(trees, blocks, totals, slots, digests, lefts, rights, subroots, roots):
        made = []
        for tree, block, total, own, values, left, right, *ends in zip(
            trees, blocks, totals, slots, digests, lefts, rights, subroots, roots
        ):
            levels = reduced(own, values, total, depth)
            for slot in own:
                near, far = beside(levels, slot)
                made.append((tree, block * ARITY**depth + slot, near + left, far + right, *ends))
        return list(zip(*made)) or [[]] * 6

    known, size = None, ARITY**depth
    for arrays in reversed(rounds):
        found = arrays.where(F.col("total") <= size).join(above, "tree")
        if known is not None:
            found = found.unionByName(arrays.where(F.col("total") > size).join(known, ["tree", "block"]))
        if arrays is rounds[0]:
            return found
        known = arrow_pass(
            found,
            ["tree", "block", "total", "slots", "digests", *_PATH],
            "tree STRING, block BIGINT, lefts ARRAY<STRING>, rights ARRAY<STRING>, subroot STRING, root STRING",
            descend,
            128,
        )
        known = written(known, "merkle-paths")
    return found


def _manifest(docs: DataFrame, presented: Column | None, depth: int) -> DataFrame:
    """One row per slot array of leaves, with its way up."""
    rows = written(leaves(docs, presented), "merkle-leaves")
    nodes = coordinates(rows).withColumnRenamed("leaf", "digest")
    rounds, subroots = grow(nodes, ("doc_id", "changed"), depth)
    subroots = written(numbered(subroots.withColumnRenamed("tree", "source_tree"), "source_tree"), "merkle-subroots")
    upper, root = grow(subroots.withColumn("tree", F.lit("")), ("source_tree",), depth)
    nothing = F.array().cast("array<string>")
    top = root.select("tree", nothing.alias("lefts"), nothing.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def spread(totals, slots, digests, names, lefts, rights, roots):
        made = []
        for total, own, values, trees, left, right, end in zip(totals, slots, digests, names, lefts, rights, roots):
            levels = reduced(own, values, total, depth)
            for slot, value, tree in zip(own, values, trees):
                near, far = beside(levels, slot)
                made.append((tree, near + left, far + right, value, end))
        return list(zip(*made)) or [[]] * 5

    above = arrow_pass(
        with_paths(upper, top, depth),
        ["total", "slots", "digests", "source_tree", "lefts", "rights", "root"],
        "tree STRING, lefts ARRAY<STRING>, rights ARRAY<STRING>, subroot STRING, root STRING",
        spread,
        128,
    )
    return with_paths(rounds, written(above, "merkle-above"), depth)


def proofs(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, lefts, rights: the way from each document's leaf to the
    root of the whole table. On each level the digests left and right of the node in its
    run of three stand joined, empty where there are none; ``fold`` gives the root again.

    Reads doc_id, source, lang, n_chars and text; other columns are ignored. Nulls in any
    of them count, as different from empty. Rows without doc_id come first in their
    source, repeated rows side by side, each with its own place and proof. An empty table
    has no rows and no root.
    """

    def step(ids, totals, slots, digests, lefts, rights, subroots, roots):
        made = []
        for own_ids, total, own, values, left, right, *ends in zip(ids, totals, slots, digests, lefts, rights, subroots, roots):
            levels = reduced(own, values, total, depth)
            for doc_id, slot, leaf in zip(own_ids, own, values):
                near, far = beside(levels, slot)
                made.append((doc_id, leaf, *ends, near + left, far + right))
        return list(zip(*made)) or [[]] * 6

    return arrow_pass(
        _manifest(docs, None, depth),
        ["doc_id", "total", "slots", "digests", *_PATH],
        "doc_id BIGINT, leaf STRING, subroot STRING, root STRING, lefts ARRAY<STRING>, rights ARRAY<STRING>",
        step,
        16,
    )


def audit(docs: DataFrame, presented: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: whether each
    document, with the text ``presented`` in place of its own, still proves to be part of
    the table. The proof is taken from the table as it is; same rules as ``proofs``."""

    def step(ids, totals, slots, digests, changed, lefts, rights, subroots, roots):
        made = []
        for own_ids, total, own, values, others, left, right, subroot, root in zip(
            ids, totals, slots, digests, changed, lefts, rights, subroots, roots
        ):
            levels = reduced(own, values, total, depth)
            for doc_id, slot, leaf, other in zip(own_ids, own, values, others):
                near, far = beside(levels, slot)
                near, far = near + left, far + right
                proof = digest(*[part for pair in zip(near, far) for part in pair])
                folded = fold(other or leaf, near, far)
                made.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
        return list(zip(*made)) or [[]] * 7

    return arrow_pass(
        _manifest(docs, presented, depth),
        ["doc_id", "total", "slots", "digests", "changed", *_PATH],
        "doc_id BIGINT, leaf STRING, subroot STRING, root STRING, proof_sha256 STRING, folded_root STRING, verified BOOLEAN",
        step,
        128,
    )
