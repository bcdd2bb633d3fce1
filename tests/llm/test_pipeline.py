"""The corpus pipeline, and the registered queries on the test data."""

import random
from collections import Counter

import pytest
from compare import compare, duck
from helpers import ODD, PROSE, brute_fingerprint, frame

import corpus_pipeline
from innmetrics.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF_DIR).count()
    assert rows > 0 if name.startswith("op3_") else rows == (250 if name.startswith("op1_") else 1000)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    docs = frame(spark, ODD)
    made = stage(spark, docs, SF_DIR)
    if name != "tokens":
        assert made.columns == docs.columns
    assert made.count() <= len(ODD)
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def plain_first(docs):
    """Of each group by comparing all fingerprints the row of the smallest id, none last."""
    prints, kept = [brute_fingerprint(text) for _, text in docs], []
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    for g in set(group):
        kept.append(min((docs[i] for i in range(len(docs)) if group[i] == g), key=lambda d: (d[0] is None, d[0] or 0)))
    return Counter(kept)


def test_near_duplicates_leave_one(spark):
    rnd = random.Random(5)
    docs = list(ODD) + [(4, "another text under an id that is taken"), (None, "a text of its own without an id")]
    for base in range(20):
        words = ["".join(rnd.choices("abcdefg", k=4)) for _ in range(rnd.randint(60, 300))]
        docs += [(100 * base + 50 - i, " ".join(words[: len(words) - i])) for i in range(4)]
    made = corpus_pipeline.keep_first_of_near_duplicates(spark, frame(spark, docs), SF_DIR)
    assert Counter((r.doc_id, r.text) for r in made.collect()) == plain_first(docs)


def test_leaks_go_also_without_an_id(spark, tmp_path):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    spark.createDataFrame([(1, " ".join(words))], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(None, " ".join(words)), (1, "clean"), (1, " ".join(words) + " more"), (None, PROSE)]
    made = corpus_pipeline.drop_benchmark_leaks(spark, frame(spark, docs), str(tmp_path))
    assert Counter((r.doc_id, r.text) for r in made.collect()) == Counter([(1, "clean"), (None, PROSE)])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, name, stage):
    docs = frame(spark, ODD).selectExpr("*", "1 AS _score", "2 AS _row", "3 AS _row_", "4 AS _group", "5 AS component_id")
    made = stage(spark, docs, SF_DIR)
    assert made.columns == docs.columns
    assert made.where("_score = 1 AND _row = 2 AND _row_ = 3 AND _group = 4 AND component_id = 5").count() == made.count()


def test_pipeline_keeps_clean_documents(spark):
    from innmetrics.llm.common import table

    made = corpus_pipeline.run(spark, SF_DIR)
    labels = table(spark, SF_DIR, "labels")
    assert made.join(labels, "doc_id").where("quality = 0").count() == 0
    assert 700 < made.count() < 900
    assert made.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
