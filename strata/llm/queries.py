"""Registered queries of this subpackage, and the SQL that computes the same rows where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    lexical_search,
    licenses,
    lm_scoring,
    near_dedup,
    packing,
    quality_rules,
    toxicity,
    url_filters,
    warc,
    whitening,
)
from strata.llm.oracle import ORACLES  # noqa: F401
from strata.llm.text import read_table

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Lets Python workers that share this machine's files import the package.

    On a cluster the package is shipped like any other (``--py-files``).
    """
    env = spark.sparkContext.environment
    known = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return lm_scoring.score_texts(read_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(read_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.roundtrip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.identify_pages(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_pieces(packing.tokenize_pieces(read_table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, item) pair of a leak, with the place and similarity of its best window."""
    leaks = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "start", F.round("similarity", 9).alias("similarity"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.withColumn("expressions", F.array_join("expressions", "\n"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return lexical_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.exact_classes(spark, f"{sf_dir}/documents.parquet")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_url_filters": op2_url_filters,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontamination": op9_decontamination,
    "op10_license_scans": op10_license_scans,
    "op11_lexical_search": op11_lexical_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}
