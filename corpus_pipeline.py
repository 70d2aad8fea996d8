"""A training corpus in five stages: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; :func:`run`
writes every stage's result to shared storage before the next one reads it.

What each stage decides: language ID drops texts that are null, have no letter or fit none of the
learned languages; line dedup deletes aligned common lines from the later document and drops
documents of which no line is left (``n_chars`` is counted again); near-dedup keeps the smallest
doc_id of each component of texts whose sets of five-word shingles have a Jaccard similarity of
0.8 or more (its name stays, SimHash itself is query op8); decontamination drops documents of
which at least a twentieth of the words lie in benchmark windows; mixing returns what the mix
takes of each document. Clean documents pass every stage; null columns pass through.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, line_dedup, mixing, similar
from tidemark.llm.durable import stored
from tidemark.llm.queries import table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEEDED = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage: Stage) -> Stage:
    """The stage with all other columns under neutral names, so none can clash with one it adds."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {c: f"_other_{k}" for k, c in enumerate(docs.columns) if c not in NEEDED}
        back = {v: k for k, v in others.items()}
        out = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        return out.select(*(others.get(c, c) for c in docs.columns)).withColumnsRenamed(back)

    return run_stage


@shielded
def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs, language.fit(docs))
    return found.where("accepted")


@shielded
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup(docs).where((F.col("n_removed") == 0) | (F.col("n_lines") > F.col("n_removed")))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


@shielded
def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


@shielded
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~decontaminate.is_contaminated())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.digest(docs)


STAGES = [("language_id", identify), ("line_dedup", dedup_lines), ("simhash_near_dedup", dedup_near), ("decontaminate", decontaminated), ("mix_sources", mixed)]

#: SQL cannot express the language models or the alignment; tests/llm compares run() with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name, wide=True)
    return STAGES[-1][1](spark, docs, sf_dir)
