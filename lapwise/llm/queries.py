"""Queries over the text tables, with the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lapwise.llm import (
    contamination,
    exact_dedup,
    filter_audit,
    importance,
    jaccard_join,
    line_spread,
    mixing,
    page_text,
    periodic_runs,
    simhash_cover,
    token_count,
    url_rules,
    warc_bundles,
)
from lapwise.llm.common import table


def op1_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(table(spark, sf_dir, "pages"))


def op2_cut_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.cut_spread_lines(table(spark, sf_dir, "documents"))


def op3_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_link_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), n=4, percent=85)


def op5_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


def op7_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mixing.quality_weights(table(spark, sf_dir, "labels"))
    return mixing.mix_sources(table(spark, sf_dir, "documents"), weights)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op10_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_link_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.link_near_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_extract_text, op2_cut_spread_lines, op3_count_tokens, op4_link_documents, op5_contaminated, op6_judge_urls,
        op7_resample, op8_mix_sources, op9_exact_dedup, op10_warc_bundles, op11_periodic_runs, op12_filter_audit,
        op13_link_near_copies,
    )
}

SQL = {
    "op2_cut_spread_lines": line_spread.SQL,
    "op5_contaminated": contamination.SQL,
    "op6_judge_urls": url_rules.SQL,
    "op8_mix_sources": mixing.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op10_warc_bundles": warc_bundles.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
