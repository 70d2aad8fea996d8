"""Emergence of topics: share of the corpus per period, growth, and quadrants.

works: work_id, published (date). assignments: work_id, topic (null for none), is_outlier.
Denominators count every work of the period, outliers included; numerators do not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions import dates
from tidemark.sources.durable import stored

SCORED, NEW, INSUFFICIENT = "scored", "newly_observed", "insufficient_historical_coverage"


def require_works(assignments: DataFrame, works: DataFrame) -> None:
    """Raises if an assignment names a work that the corpus lacks."""
    lost = assignments.join(works, "work_id", "left_anti").select("work_id").limit(1).collect()
    if lost:
        raise ValueError(f"assignment work {lost[0][0]} is missing from the corpus")


def _spine(works: DataFrame, values: Column, name: str) -> DataFrame:
    """One row per period; a driver-made constant, so it costs no scan."""
    return works.sparkSession.range(1).select(F.explode(values).alias(name))


def _period_counts(works: DataFrame, assignments: DataFrame, period: Column, name: str) -> tuple[DataFrame, DataFrame]:
    dated = works.select("work_id", period.alias(name))
    corpus = dated.groupBy(name).agg(F.count("*").alias("corpus_count"))
    members = assignments.where(~F.col("is_outlier") & F.col("topic").isNotNull()).select("work_id", "topic")
    return corpus, members.join(dated, "work_id").groupBy("topic", name).agg(F.count("*").alias("topic_count"))


def _grid(topics: DataFrame, spine: DataFrame, corpus: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """Dense topic x period table with zero counts and a share that is null where the corpus is empty."""
    zero = F.lit(0).cast("bigint")
    out = topics.crossJoin(F.broadcast(spine)).join(corpus, name, "left").join(counts, ["topic", name], "left")
    out = out.withColumn("topic_count", F.coalesce("topic_count", zero)).withColumn("corpus_count", F.coalesce("corpus_count", zero))
    return out.withColumn("share", F.when(F.col("corpus_count") > 0, F.col("topic_count") / F.col("corpus_count")))


def monthly_series(works: DataFrame, assignments: DataFrame, topics: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """topic, month, topic_count, corpus_count, share for every month that the interval touches.

    The grid is topics x months; both are small next to the works.
    """
    corpus, counts = _period_counts(works, assignments, F.trunc("published", "MM"), "month")
    return _grid(topics.select("topic"), _spine(works, dates.months_touched(F.lit(first), F.lit(last)), "month"), corpus, counts, "month")


def yearly_series(works: DataFrame, assignments: DataFrame, topics: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """topic, year, topic_count, corpus_count, share for every complete year of the interval."""
    corpus, counts = _period_counts(works, assignments, F.year("published"), "year")
    return _grid(topics.select("topic"), _spine(works, dates.complete_years(F.lit(first), F.lit(last)), "year"), corpus, counts, "year")


def yearly_from_monthly(monthly: DataFrame, years: list[int]) -> DataFrame:
    """What :func:`yearly_series` gives, from the months of complete years."""
    out = monthly.withColumn("year", F.year("month")).where(F.col("year").isin(years)).groupBy("topic", "year").agg(F.sum("topic_count").alias("topic_count"), F.sum("corpus_count").alias("corpus_count"))
    return out.withColumn("share", F.when(F.col("corpus_count") > 0, F.col("topic_count") / F.col("corpus_count")))


def log_ratio(adjacent: Column, following: Column) -> Column:
    return F.when(adjacent & (F.col("share") > 0) & (following > 0), F.ln(following / F.col("share")))


def monthly_share_change(series: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """topic, monthly_share_change: geometric mean of the ratios of calendar-adjacent complete months, less one."""
    full = series.where(dates.is_complete_month(F.col("month"), F.lit(first), F.lit(last)))
    w = W.partitionBy("topic").orderBy("month")
    pairs = full.withColumn("ratio", log_ratio(F.add_months("month", 1) == F.lead("month").over(w), F.lead("share").over(w)))
    return pairs.groupBy("topic").agg((F.exp(F.avg("ratio")) - 1).alias("monthly_share_change"))


def annual_growth(yearly: DataFrame) -> DataFrame:
    """topic, mean_share, annual_growth (null without a pair), valid_year_pair_count."""
    w = W.partitionBy("topic").orderBy("year")
    pairs = yearly.withColumn("ratio", log_ratio(F.col("year") + 1 == F.lead("year").over(w), F.lead("share").over(w)))
    return pairs.groupBy("topic").agg(F.avg("share").alias("mean_share"), (F.exp(F.avg("ratio")) - 1).alias("annual_growth"), F.count("ratio").alias("valid_year_pair_count"))


def quadrants(scored: DataFrame) -> DataFrame:
    """Adds coverage_status and emergence_quadrant: share against the median of scored topics, growth against zero."""
    is_scored = F.col("valid_year_pair_count") > 0
    median = scored.where(is_scored).agg(F.median("mean_share").alias("_median"))
    high, rising = F.col("mean_share") >= F.col("_median"), F.col("annual_growth") > 0
    named = F.when(is_scored & high & rising, "wisdom_strong").when(is_scored & ~high & rising, "wisdom_weak").when(is_scored & ~high & ~rising, "latent").when(is_scored & high & ~rising, "nswk")
    out = scored.crossJoin(F.broadcast(median))
    out = out.withColumn("emergence_quadrant", named).withColumn("coverage_status", F.when(is_scored, SCORED).otherwise(NEW))
    return out.withColumn("annual_growth", F.when(is_scored, F.col("annual_growth")).otherwise(F.lit(-1.0))).drop("_median")


def observe(works: DataFrame, assignments: DataFrame, topics: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per topic: series, monthly change, annual metrics, status and quadrant. Works are counted once, by month."""
    monthly = stored(monthly_series(works, assignments, topics, first, last), "monthly")
    point = F.struct(F.date_format("month", "yyyy-MM").alias("year_month"), "topic_count", "corpus_count", "share")
    series = monthly.groupBy("topic").agg(F.array_sort(F.collect_list(point)).alias("monthly_series"))
    out = series.join(monthly_share_change(monthly, first, last), "topic", "left")
    years = [y for y in range(first.year, last.year + 1) if first <= dt.date(y, 1, 1) and last >= dt.date(y, 12, 31)]
    if len(years) < 2:
        empty = {"complete_years": "array<int>", "mean_share": "double", "annual_growth": "double", "valid_year_pair_count": "bigint", "emergence_quadrant": "string"}
        out = out.withColumns({k: (F.array() if k == "complete_years" else F.lit(None)).cast(t) for k, t in empty.items()})
        return out.withColumn("coverage_status", F.lit(INSUFFICIENT))
    scored = quadrants(annual_growth(yearly_from_monthly(monthly, years)))
    return out.join(scored, "topic").withColumn("complete_years", F.array(*map(F.lit, years)))


def run_status(rows: DataFrame) -> DataFrame:
    """One row: the distinct statuses, sorted and joined; ``none`` for no rows."""
    joined = F.array_join(F.sort_array(F.collect_set("coverage_status")), ",")
    return rows.agg(F.when(joined == "", "none").otherwise(joined).alias("coverage_status"))
