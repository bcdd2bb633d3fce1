"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innmetrics.llm import (
    alignment, bpe, decontaminate, html, language, licenses, merkle, mixing, quality_classifier, quality_rules, secrets,
    simhash, suffix_dedup,
)
from innmetrics.llm.common import table


def held_out(parts: int, part: int) -> Column:
    """Whether the hash of doc_id falls into one of so many parts; not for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
        "n_confirmed",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, ~held_out(3, 1))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "bits_per_char", "rejected")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    scored = quality_classifier.score(docs, model)
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", predicted.alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents whose id has an even CRC the line ends are taken out before the proof."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.audit(table(spark, sf_dir, "documents"), F.coalesce(tampered, "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_secret_scans,
        op3_decontamination,
        op4_simhash,
        op5_language_id,
        op6_quality_classifier,
        op7_bpe,
        op8_license_scans,
        op9_suffix_dedup,
        op10_quality_rules,
        op11_source_mixing,
        op12_tokenizer_alignment,
        op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {"op8_license_scans": licenses.duckdb_sql(), "op11_source_mixing": mixing.duckdb_sql()}
