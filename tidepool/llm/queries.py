"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import collocations, decontaminate, fingerprint, html_extract, jaccard, line_dedup, mixing, pii, quality, spelling, sql, substring_dedup, token_count, warc
from tidepool.llm.common import shared_path, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, sf_dir, "pages"), shared_path(spark, "archives"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_mix_sources, op3_line_dedup, op4_quality, op5_pii, op6_html, op7_substring_dedup,
        op8_fingerprint, op9_jaccard, op10_warc, op11_token_counts, op12_spelling_variants, op13_collocations)
}

ORACLE_SQL: dict[str, str] = {"op1_decontaminate": sql.OP1, "op2_mix_sources": sql.OP2, "op3_line_dedup": sql.OP3,
                              "op7_substring_dedup": sql.OP7, "op9_jaccard": sql.OP9, "op10_warc": sql.OP10,
                              "op12_spelling_variants": sql.OP12, "op13_collocations": sql.OP13}
