"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, html_text, language, line_dedup, merkle, mixing, ngram_join, oracles, outliers, quality, simhash, substrings, suffixes, vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(digest: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": _documents(mixing.digest),
        "op2_decontaminate": lambda spark, sf_dir: decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op3_quality": lambda spark, sf_dir: quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op4_line_dedup": _documents(line_dedup.digest),
        "op5_outliers": _documents(outliers.digest),
        "op6_substring_dedup": _documents(substrings.digest),
        "op7_suffix_dedup": _documents(suffixes.digest),
        "op8_simhash": _documents(simhash.digest),
        "op9_language": _documents(language.digest),
        "op10_html_text": lambda spark, sf_dir: html_text.digest(table(spark, sf_dir, "pages")),
        "op11_ngram_join": _documents(ngram_join.digest),
        "op12_vector_codes": lambda spark, sf_dir: vector_codes.digest(table(spark, sf_dir, "embeddings")),
        "op13_merkle_manifest": _documents(merkle.digest),
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
