"""Attention: planned scan windows, scan outcomes, and the monthly cube with explicit coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates

CELL = ["platform", "channel", "month"]


def topic_mentions(links: DataFrame, matched: DataFrame) -> DataFrame:
    """topic_id, mention_id: one row however many terms of the topic the mention matched."""
    return links.select("topic_id", "term_id").join(matched.select("term_id", "mention_id"), "term_id").select("topic_id", "mention_id").distinct()


def measures(links: DataFrame, matched: DataFrame, mentions: DataFrame, period: Column, start: Column, end: Column) -> DataFrame:
    """mentions, authors (null ids not counted) and engagement by topic, platform, channel and period."""
    inside = mentions.where((F.col("created_at") >= start) & (F.col("created_at") < end))
    rows = topic_mentions(links, matched).join(inside, "mention_id").withColumn("month", period)
    return rows.groupBy("topic_id", *CELL).agg(F.count("*").alias("mentions"), F.countDistinct("author_hash").alias("authors"), F.coalesce(F.sum("engagement"), F.lit(0)).alias("engagement"))


def observed_cells(scans: DataFrame, periods: Column | None = None) -> DataFrame:
    """platform, channel, term_id, month, status, reported_total of terminal scans; of overlapping ones the highest id wins."""
    done = scans.where(F.col("status").isin("complete", "truncated"))
    cells = done.withColumn("month", F.explode(periods if periods is not None else dates.months(F.col("window_start"), F.col("window_end"))))
    last = F.max_by(F.struct("status", "reported_total"), "scan_id").alias("s")
    return cells.groupBy("platform", "channel", "term_id", "month").agg(last).select("platform", "channel", "term_id", "month", "s.status", "s.reported_total")


def coverage(links: DataFrame, cells: DataFrame, spine: DataFrame) -> DataFrame:
    """coverage and truncated_total per topic and cell of the spine (platform, channel, month)."""
    terms = links.select("topic_id", "term_id").distinct()
    states = terms.crossJoin(spine).join(cells, ["platform", "channel", "term_id", "month"], "left")
    known, cut = F.count("status"), F.count(F.when(F.col("status") == "truncated", 1))
    state = F.when(known == 0, "missing").when(known < F.count("*"), "partial").when(cut > 0, "truncated").otherwise("complete")
    total = F.max(F.when(F.col("status") == "truncated", F.coalesce("reported_total", F.lit(0))))
    return states.groupBy("topic_id", *CELL).agg(state.alias("coverage"), known.alias("known"), F.coalesce(total, F.lit(0)).alias("truncated_total"))


def cube(links: DataFrame, counted: DataFrame, covered: DataFrame, volumes: DataFrame) -> DataFrame:
    """The attention cube: every topic and cell with measures, estimate, volume, share and coverage.

    ``estimated`` is null where nothing was observed; ``share`` where estimate or volume is missing or zero.
    """
    zero = F.lit(0).cast("bigint")
    rows = covered.join(counted, ["topic_id", *CELL], "left").join(volumes.select(*CELL, F.col("total").alias("volume")), CELL, "left")
    rows = rows.withColumns({c: F.coalesce(c, zero) for c in ("mentions", "authors")} | {"engagement": F.coalesce("engagement", F.lit(0))})
    rows = rows.withColumn("estimated", F.when(F.col("known") > 0, F.greatest("mentions", F.col("truncated_total").cast("bigint"))))
    rows = rows.withColumn("share", F.when(F.col("volume") != 0, F.col("estimated") / F.col("volume")))
    return rows.select("topic_id", *CELL, "mentions", "authors", "engagement", "estimated", "volume", "share", "coverage")


def plan_windows(terms: DataFrame, channels: DataFrame, scans: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Root windows from each (channel, term)'s covered boundary to end; empty ones are left out."""
    edge = scans.where(F.col("parent_id").isNull()).groupBy("channel", "term_id").agg(F.max("window_end").alias("edge"))
    grid = terms.select("term_id").distinct().crossJoin(channels.select("channel").distinct())
    first = F.greatest(F.coalesce("edge", F.lit(start)), F.lit(start))
    rows = grid.join(edge, ["channel", "term_id"], "left").select("channel", "term_id", first.alias("window_start"), F.lit(end).alias("window_end"))
    return rows.where("window_start < window_end")


def scan_status(total: Column, fetched: Column, has_more: Column, cap: int, span: Column) -> Column:
    """complete, split or truncated: a window that holds more than the cap splits while it has two months."""
    more = (F.coalesce(total, F.lit(0)) > cap) & (span > 1)
    over = (fetched >= cap) & has_more | (total.isNotNull() & (total > fetched))
    return F.when(more, "split").when(over & (span > 1), "split").when(over, "truncated").otherwise("complete")


def split_children(scans: DataFrame) -> DataFrame:
    """The two half windows of every split scan, as pending children without repeats."""
    half = F.explode(dates.halves(F.col("window_start"), F.col("window_end"))).alias("w")
    kids = scans.where("status = 'split'").select("platform", "channel", "term_id", F.col("scan_id").alias("parent_id"), half)
    out = kids.select("platform", "channel", "term_id", "parent_id", "w.window_start", "w.window_end", F.lit("pending").alias("status"))
    return out.dropDuplicates(["platform", "channel", "term_id", "window_start", "window_end"])


def runnable(run_started: Column, now: Column, max_attempts: int = 3) -> Column:
    """Pending; claimed with an expired lease; or failed fewer than max_attempts times and not in this run."""
    status = F.col("status")
    return (status == "pending") | ((status == "claimed") & (F.col("lease_until") < now)) | ((status == "failed") & (F.col("attempts") < max_attempts) & (F.col("updated_at") < run_started))


def missing_volumes(spine: DataFrame, volumes: DataFrame) -> DataFrame:
    """Cells of the spine without a stored volume."""
    return spine.join(volumes.select(*CELL), CELL, "left_anti")


def failure_streaks(outcomes: DataFrame, limit: int = 5) -> DataFrame:
    """Per run whether ``limit`` failures in a row occurred; outcomes: run_id, position, ok."""
    from pyspark.sql.window import Window as W

    w = W.partitionBy("run_id").orderBy("position")
    marked = outcomes.withColumn("island", F.sum(F.col("ok").cast("int")).over(w))
    streak = marked.where(~F.col("ok")).groupBy("run_id", "island").agg(F.count("*").alias("n"))
    return outcomes.select("run_id").distinct().join(streak.groupBy("run_id").agg(F.max("n").alias("longest")), "run_id", "left").select("run_id", F.coalesce("longest", F.lit(0)).alias("longest"), (F.coalesce("longest", F.lit(0)) >= limit).alias("aborted"))
