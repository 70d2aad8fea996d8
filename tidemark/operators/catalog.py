"""Taxonomy checks, search profiles, queue and progress reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.binding import let


def identity_defects(records: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """id, kind, defect: malformed_id, duplicate_id, missing_name; records: kind, id, display_name."""
    seen = records.groupBy("id").agg(F.count("*").alias("_n"))
    good = F.when(F.lit(False), F.lit(False))
    for kind, pattern in patterns.items():
        good = good.when(F.col("kind") == kind, F.coalesce(F.col("id").rlike(f"^(?:{pattern})$"), F.lit(False)))
    rows = records.join(seen, "id", "left")
    defect = F.array_compact(F.array(F.when(~F.coalesce(good, F.lit(False)), "malformed_id"), F.when(F.col("_n") > 1, "duplicate_id"), F.when(F.col("display_name").isNull(), "missing_name")))
    return rows.select("id", "kind", F.explode(defect).alias("defect"))


def empty_kinds(records: DataFrame, kinds: list[str]) -> DataFrame:
    """Kinds without a record."""
    every = records.sparkSession.createDataFrame([(k,) for k in kinds], "kind string")
    return every.join(records, "kind", "left_anti")


def unresolved_parents(children: DataFrame, parents: DataFrame, parent: str, key: str) -> DataFrame:
    """Children whose parent reference is null or not among the parents' key."""
    return children.join(parents.select(F.col(key).alias(parent)), parent, "left_anti")


def inconsistent_ancestry(children: DataFrame, parents: DataFrame, parent: str, key: str, ancestor: str) -> DataFrame:
    """Children whose own ancestor differs from their parent's."""
    up = parents.select(F.col(key).alias(parent), F.col(ancestor).alias("_of_parent"))
    return children.join(up, parent).where(~F.col(ancestor).eqNullSafe(F.col("_of_parent"))).drop("_of_parent")


def select_topics(counts: DataFrame, limit: int, explicit: list[str] | None = None) -> DataFrame:
    """Known explicit ids in the order given, else the top ones by (count descending, id)."""
    if explicit:
        wanted = counts.sparkSession.createDataFrame(list(enumerate(explicit)), "position int, topic_id string")
        return counts.join(wanted, "topic_id").orderBy("position").drop("position")
    return counts.orderBy(F.desc("n"), "topic_id").limit(limit)


def profile_terms(phrases: DataFrame, excluded: list[str], min_length: int) -> DataFrame:
    """topic_id, term_id, term, normalized, origin of the eligible terms, each once a topic; the lowest position decides.

    phrases: topic_id, position, phrase, origin.
    """
    rows = phrases.withColumn("term", text.phrase_text(F.col("phrase"))).withColumn("normalized", text.normalize(F.col("term")))
    rows = rows.where(F.length("normalized") >= min_length)
    if excluded:
        rows = rows.where(~F.col("normalized").isin(*excluded))
    first = rows.groupBy("topic_id", "normalized").agg(F.min_by(F.struct("term", "origin"), "position").alias("t"))
    return first.select("topic_id", text.term_id(F.col("normalized")).alias("term_id"), "t.term", "normalized", "t.origin")


def specific_terms(terms: DataFrame, words: int = 2) -> DataFrame:
    """Display names, and phrases of at least so many words."""
    return terms.where((F.col("origin") == "display_name") | (F.size(F.split("normalized", " ")) >= words))


def status_counts(queue: DataFrame, statuses: list[str]) -> DataFrame:
    """One row with a count per status."""
    return queue.agg(*(F.count(F.when(F.col("status") == s, 1)).alias(s) for s in statuses))


def progress(files: DataFrame, sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: files and bytes known and acquired, rows and chunks committed, percent of rows.

    files: file, bytes, rows. sources: file. chunks: file, row_count. Every side is brought to one
    row a file first, so nothing is counted once per match.
    """
    got = sources.select("file").distinct().withColumn("got", F.lit(1))
    done = chunks.groupBy("file").agg(F.count("*").alias("chunks"), F.sum("row_count").alias("done"))
    rows = files.join(got, "file", "left").join(done, "file", "left")
    zero = F.lit(0).cast("bigint")
    out = rows.agg(F.count("*").alias("files"), F.count("got").alias("acquired"), F.sum("bytes").alias("bytes"), F.coalesce(F.sum(F.when(F.col("got") == 1, F.col("bytes"))), zero).alias("acquired_bytes"), F.coalesce(F.sum("chunks"), zero).alias("chunks"), F.coalesce(F.sum("done"), zero).alias("rows_done"), F.sum("rows").alias("rows"))
    return out.withColumn("percent", F.round(F.try_divide(100.0 * F.col("rows_done"), F.col("rows")), 2))


def file_completeness(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """file, complete: chunks exist and their rows add up to the file's."""
    done = chunks.groupBy("file").agg(F.count("*").alias("n"), F.sum("row_count").alias("done"))
    rows = files.join(done, "file", "left")
    return rows.select("file", F.coalesce((F.col("n") > 0) & (F.col("done") == F.col("rows")), F.lit(False)).alias("complete"))


def refresh_queue(days: DataFrame, today: dt.date, recent: int = 29) -> DataFrame:
    """day, queue, position: recent days by nearness to today, the others never completed first, then oldest.

    days: day, completed_at (null if never). Positions come from two sorted windows over calendar
    days, a table that does not grow with the data.
    """
    from pyspark.sql.window import Window as W

    distance = F.abs(F.date_diff(F.lit(today), F.col("day")))
    rows = days.withColumn("queue", F.when(F.col("day") >= F.date_sub(F.lit(today), recent), "recent").otherwise("rotating"))
    near = F.row_number().over(W.partitionBy("queue").orderBy(distance, "day"))
    old = F.row_number().over(W.partitionBy("queue").orderBy(F.col("completed_at").isNotNull(), "completed_at", "day"))
    return rows.select("day", "queue", F.when(F.col("queue") == "recent", near).otherwise(old).alias("position"))


def budget(capacity: Column, recent_fraction: float, recent_waiting: Column, rotating_waiting: Column) -> Column:
    """struct(recent, rotating): units for the two queues; what one leaves unused the other borrows. Halves round to even."""
    share = F.bround(capacity * F.lit(recent_fraction), 0).cast("bigint")
    first = F.struct(F.least(share, recent_waiting).alias("a"), F.least(capacity - share, rotating_waiting).alias("b"))

    def lent(x: Column) -> Column:
        more = x["a"] + F.least(capacity - x["a"] - x["b"], recent_waiting - x["a"])
        return F.struct(more.alias("recent"), (x["b"] + F.least(capacity - more - x["b"], rotating_waiting - x["b"])).alias("rotating"))

    return let(first, lent)


def partition_report(partitions: DataFrame) -> DataFrame:
    return partitions.groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"))


def measure_by_path(rows: DataFrame, at: Column, value: Column) -> DataFrame:
    """path, least, greatest, n of a value grouped by a payload path."""
    return rows.groupBy(at.alias("path")).agg(F.min(value).alias("least"), F.max(value).alias("greatest"), F.count("*").alias("n"))
