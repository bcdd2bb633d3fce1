"""License scans: rolling word hashes joined to template positions, voted by diagonal.

A hit pairs word position p of a text with word position t of a template; copies of the
template line up on the diagonal p - t, and words put in or left out move it by a few.
Only DataFrame operations are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innmetrics.llm.common import written

#: Words of a hashed run.
RUN = 3
#: Diagonals so far apart are merged.
DRIFT = 2
#: Share of a template's runs that a verified span holds.
MIN_COVERAGE = 0.7

# Phrases that count by themselves, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of well-known public license notices.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "released under the MIT license"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

#: What stands between words; capital letters are lowered before.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(GAPS, text.lower()) if w]


def templates() -> list[tuple[int, str, bool, list[str]]]:
    """id, label, whether it is a phrase, words."""
    found = [(label, True, text) for text, label in PHRASES.items()]
    found += [(label, False, text) for label, text in NOTICES]
    return [(i, label, phrase, template_words(text)) for i, (label, phrase, text) in enumerate(found)]


def template_runs(spark: SparkSession) -> DataFrame:
    """hash, run (its words), template, label, phrase, at, n_runs; a few hundred rows."""
    values = ", ".join(
        f"(array({', '.join(map(repr, words[at : at + RUN]))}), {template}, '{label}', {phrase}, {at}, "
        f"{len(words) - RUN + 1})"
        for template, label, phrase, words in templates()
        for at in range(len(words) - RUN + 1)
    )
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS runs(run, template, label, phrase, at, n_runs)")
    return frame.withColumn("hash", run_hash(F.col("run"), F.lit(1)))


def run_hash(words: Column, start: Column) -> Column:
    """Hash of RUN words from the 1-based position ``start``."""
    return F.xxhash64(*[F.get(words, start + (i - 1)) for i in range(RUN)])


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, GAPS), lambda w: w != "")


def license_hits(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_words and hits: the 0-based positions whose run hash is that of
    some template run, with their words.

    Every run of every text is hashed. Lower-casing for the hash may be wider than A-Z,
    which can only add hits; their words are then compared with A-Z alone lowered.
    """
    spark = docs.sparkSession
    hashes = [r.hash for r in template_runs(spark).select("hash").distinct().collect()]
    wide = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("words", split_words(F.lower("text")))
    starts = F.when(
        F.size("words") >= RUN,
        F.filter(
            F.sequence(F.lit(1), F.size("words") - (RUN - 1)),
            lambda i: run_hash(F.col("words"), i).isin(hashes),
        ),
    )
    near = wide.select("row_id", "doc_id", "text", F.size("words").cast("bigint").alias("n_words"), starts.alias("starts"))
    exact = split_words(F.translate("text", _UPPER, _LOWER))
    return near.withColumn("exact", F.when(F.size("starts") > 0, exact)).select(
        "row_id",
        "doc_id",
        "n_words",
        F.transform(
            "starts",
            lambda i: F.struct((i - 1).alias("pos"), F.slice("exact", i, RUN).alias("run")),
        ).alias("hits"),
    )


def diagonal_votes(hits: DataFrame) -> DataFrame:
    """row_id, template, label, phrase, n_runs, diagonal, ats: which runs of a template
    stand on a diagonal of a text."""
    rows = hits.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("hit"))
    rows = rows.select("row_id", "hit.pos", "hit.run").withColumn("hash", run_hash(F.col("run"), F.lit(1)))
    met = rows.join(F.broadcast(template_runs(hits.sparkSession)), ["hash", "run"])
    return (
        met.withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy("row_id", "template", "label", "phrase", "n_runs", "diagonal")
        .agg(F.collect_set("at").alias("ats"))
    )


def license_spans(votes: DataFrame) -> DataFrame:
    """row_id, template, label, phrase, first_word, coverage of every template and
    diagonal after neighbouring diagonals are merged; phrases must stand on one alone."""
    close = Window.partitionBy("row_id", "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    merged = F.array_distinct(F.flatten(F.collect_list("ats").over(close)))
    held = F.size(F.when(F.col("phrase"), F.col("ats")).otherwise(merged))
    return votes.select(
        "row_id", "template", "label", "phrase", F.col("diagonal").alias("first_word"), (held / F.col("n_runs")).alias("coverage")
    )


def scan_licenses(docs: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Reads doc_id and text; other columns are ignored. A null text counts as empty: no
    words, null positions, empty labels, score 0. Every row of the input gives one row,
    also where rows or ids repeat. ``score`` is the largest coverage of any template.
    """
    rows = written(license_hits(docs), "license-hits")
    spans = license_spans(diagonal_votes(rows))
    whole = F.col("phrase") & (F.col("coverage") == 1.0)
    verified = whole | (~F.col("phrase") & (F.col("coverage") >= min_coverage))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    found = spans.groupBy("row_id").agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("first_word"))).cast("bigint").alias("first_word"),
        F.max(F.when(whole, F.col("first_word"))).cast("bigint").alias("last_word"),
        joined(F.collect_set(F.when(whole, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(verified, F.col("label")))).alias("labels"),
        F.max("coverage").alias("score"),
    )
    return rows.join(found, "row_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def duckdb_sql(min_coverage: float = MIN_COVERAGE) -> str:
    """The same in DuckDB SQL, with the words of a run in place of their hash."""
    quoted = ", ".join(
        f"({t}, '{label}', {str(phrase).lower()}, {at}, {len(words) - RUN + 1}, '{' '.join(words[at : at + RUN])}')"
        for t, label, phrase, words in templates()
        for at in range(len(words) - RUN + 1)
    )
    return f"""
WITH runs(template, label, phrase, spot, n_runs, run) AS (VALUES {quoted}),
docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                     '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
words AS (SELECT row_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos FROM docs),
grams AS (
  SELECT row_id, pos, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS run
  FROM words WINDOW o AS (PARTITION BY row_id ORDER BY pos)),
votes AS (
  SELECT row_id, template, label, phrase, n_runs, pos - spot AS diagonal, list(DISTINCT spot) AS spots
  FROM grams JOIN runs USING (run) GROUP BY ALL),
spans AS (
  SELECT v.row_id, v.template, v.label, v.phrase, v.n_runs, v.diagonal, count(DISTINCT u.spot) AS held
  FROM votes v JOIN (SELECT *, unnest(spots) AS spot FROM votes) u
    ON u.row_id = v.row_id AND u.template = v.template
   AND u.diagonal BETWEEN v.diagonal AND v.diagonal + CASE WHEN v.phrase THEN 0 ELSE {DRIFT} END
  GROUP BY ALL),
rated AS (
  SELECT *, held / n_runs AS coverage, phrase AND held = n_runs AS whole,
         (phrase AND held = n_runs) OR (NOT phrase AND held / n_runs >= {min_coverage}) AS verified
  FROM spans),
found AS (
  SELECT row_id, count(*) FILTER (whole) AS n_base, min(diagonal) FILTER (whole) AS first_word,
         max(diagonal) FILTER (whole) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified) AS labels,
         max(coverage) AS score
  FROM rated GROUP BY row_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN found USING (row_id)"""
