"""Mixing sources to target weights by nested hash thresholds.

Every document has a hash. A source that may give some words gives the documents whose
hash lies below a threshold, so a larger budget takes all that a smaller one takes, and
some more; a budget beyond the whole source takes everything once and the rest as second
copies. The threshold is found in a histogram of words by source and hash bucket: running
sums show the bucket that the budget ends in, and only that bucket is looked at more
closely. No documents are sorted. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innmetrics.llm.common import numbered, written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words, and how often a source may be taken.
SHARE, MOST = 1.5, 2
#: Bits of a document's hash, of a row's number, and of one histogram.
HASH_BITS, ROW_BITS, STEP_BITS = 60, 63, 10

_BEFORE = (Window.unboundedPreceding, -1)

# Fixed value: a word, as everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, source, name (never null), size, hash, row. The hash follows from id and text, so
    it doesn't depend on how the rows are spread; ``row`` tells equal rows apart."""
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),
        word_count(F.col("text")).alias("size"),
        F.conv(F.substring(F.md5(identity), 1, HASH_BITS // 4), 16, 10).cast("bigint").alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )


def source_targets(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """name, source_size, target: the words each source should give.

    Targets go by weight and stop at ``most`` times the size of the source; what is left
    over is shared by weight among the others until none is above. Each round is one
    aggregate over a row per source.
    """
    sizes = rows.groupBy("name").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sizes, F.col("name") == "", F.col("name"))  # rows without a source come last
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    most_words = (F.lit(float(most)) * F.col("source_size")).alias("most")
    sources = written(ranked.select("name", "source_size", most_words, weight.alias("weight")), "mix-sources")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("most") < F.col("weight") * level if full >= 0 else F.lit(False)
        found = sources.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if found[0] == full or not found[2]:
            break
        full, level = found[0], (budget - found[1]) / found[2]
    target = F.least("most", F.col("weight") * level).alias("target")
    return sources.select("name", "source_size", target)


def boundaries(rows: DataFrame, budgets: DataFrame, key: str, bits: int) -> DataFrame:
    """name, cut, rest, n_rows, first_row, last_size: the key at which each budget ends.

    ``budgets`` has name and rest, above zero and at most the words of the source. Rows
    with a smaller key fit whole; ``rest`` is what they leave. In each step a bucket takes
    STEP_BITS more bits of the key, and only rows of the buckets that budgets end in are
    read on; it ends when these hold one key each.
    """
    live, open_budgets = rows, budgets
    shift = bits
    while True:
        shift = max(shift - STEP_BITS, 0)
        bucket = F.shiftright(F.col(key), shift).alias("bucket")
        buckets = live.groupBy("name", bucket).agg(
            F.sum("size").alias("words"),
            F.count("*").alias("n_rows"),
            F.min(key).alias("cut"),
            F.max(key).alias("last"),
            F.min("row").alias("first_row"),
            F.max("size").alias("last_size"),
        )
        order = Window.partitionBy("name").orderBy("bucket").rowsBetween(*_BEFORE)  # 1024 buckets of a source
        running = buckets.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
        ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))
        found = running.join(open_budgets, "name").where(ends).withColumn("rest", F.col("rest") - F.col("before"))
        found = written(found.drop("before", "words"), "mix-buckets")
        if shift == 0 or found.where("cut <> last").isEmpty():
            return found.drop("bucket", "last")
        live = written(
            live.withColumn("bucket", bucket).join(found.select("name", "bucket"), ["name", "bucket"]).drop("bucket"),
            "mix-boundary",
        )
        open_budgets = found.select("name", "rest")


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: how often the mix takes each
    document, and the words that makes.

    Documents are taken whole. In the order of their hash a source gives those that bring
    it nearer to its target, so it misses it by half of one document at most. Reads doc_id,
    source and text; other columns are ignored. A null text has no words; rows without a
    source are a source of their own, the last in order. Of repeated rows, which have one
    hash, as many are taken as fit: which of them is left open, but they are equal, so the
    result is the same each time. Nothing is taken of an empty table.
    """
    rows = written(hashed(docs), "mix-rows")
    targets = source_targets(rows, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    plan = targets.withColumn("whole", whole.cast("bigint"))
    plan = written(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    cuts = boundaries(rows, plan.where("rest > 0").select("name", "rest"), "hash", HASH_BITS)
    single = cuts.where("n_rows = 1").select(
        "name", "cut", F.col("first_row").alias("cut_row"), (2 * F.col("rest") >= F.col("last_size")).alias("nearer")
    )
    several = cuts.where("n_rows > 1").select("name", "cut", "rest")
    if not several.isEmpty():  # equal rows, told apart by their number
        same = written(
            rows.join(several.select("name", F.col("cut").alias("hash")), ["name", "hash"]), "mix-equal-rows"
        )
        ended = boundaries(same, several.select("name", "rest"), "row", ROW_BITS)
        single = single.unionByName(
            several.select("name", "cut").join(
                ended.select("name", F.col("cut").alias("cut_row"), (2 * F.col("rest") >= F.col("last_size")).alias("nearer")),
                "name",
            )
        )
    plan = plan.join(written(single, "mix-cuts"), "name", "left")
    at_cut = (F.col("row") < F.col("cut_row")) | ((F.col("row") == F.col("cut_row")) & F.col("nearer"))
    more = (F.col("hash") < F.col("cut")) | ((F.col("hash") == F.col("cut")) & at_cut)
    copies = F.col("whole") + F.when(more, 1).otherwise(0)
    return rows.join(plan, "name").select(
        "doc_id",
        F.expr("if(name = '', NULL, substring(name, 2))").alias("source"),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def duckdb_sql(weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> str:
    """The same in DuckDB SQL, by sorting: targets by the order in which sources fill up,
    documents by running sums in the order of their hash."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4})
              AS BIGINT) AS hash
  FROM documents),
sources AS (
  SELECT *, CAST({most} AS DOUBLE) * source_size AS most, CAST(list_extract({list(weights)}, 1 + place % {len(weights)}) AS DOUBLE) AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM docs GROUP BY source)),
filled AS (
  SELECT row_number() OVER o AS turn, most / weight AS full_at,
         (CAST({share} AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW o AS (ORDER BY most / weight, place)),
level AS (SELECT coalesce(arg_min(level, turn) FILTER (full_at >= level), max(level)) AS level FROM filled),
plan AS (
  SELECT *, least(most, weight * level) AS target,
         CASE WHEN source_size > 0 THEN least({most}, floor(least(most, weight * level) / source_size)) ELSE 0 END AS whole
  FROM sources, level),
sums AS (
  SELECT docs.*, source_size, target, whole, target - whole * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY hash, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN plan ON docs.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN 2 * (rest - before) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums"""
