"""Monthly metrics by topic and country, pivots, histograms, extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shares(monthly: DataFrame) -> DataFrame:
    """preprint_share_pct, citations_per_work, funded_works_share_pct per row; an empty month gives 0."""
    ratio = lambda a, scale: F.coalesce(F.try_divide(F.col(a) * F.lit(scale), F.col("works")), F.lit(0.0))
    return monthly.withColumns({"preprint_share_pct": ratio("preprints", 100.0), "citations_per_work": ratio("citations", 1.0), "funded_works_share_pct": ratio("funded", 100.0)})


def summary(monthly: DataFrame, sums: list[str], means: list[str]) -> DataFrame:
    return monthly.groupBy("topic").agg(*(F.sum(c).alias(f"{c}_sum") for c in sums), *(F.avg(c).alias(f"{c}_mean") for c in means))


def top(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The k rows that are greatest by a column, ties by key."""
    return df.orderBy(F.desc(by), key).limit(k)


def pivot_counts(df: DataFrame, rows: str, columns: str, names: list, value: str) -> DataFrame:
    """One row per ``rows`` value, a summed column per name, missing ones 0; stated names spare a scan."""
    return df.groupBy(rows).pivot(columns, names).agg(F.sum(value)).fillna(0)


def within_top(df: DataFrame, key: str, by: str, k: int) -> DataFrame:
    """Rows of the k keys with the greatest total."""
    best = df.groupBy(key).agg(F.sum(by).alias("_total")).orderBy(F.desc("_total"), key).limit(k)
    return df.join(best.select(key), key, "left_semi")


def histogram(value: Column, low: float, high: float, bins: int) -> Column:
    return F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins))


def extremes(sizes: DataFrame, by: str, key: str, k: int = 5) -> DataFrame:
    """The k largest and k smallest rows, tagged."""
    return sizes.orderBy(F.desc(by), key).limit(k).withColumn("tag", F.lit("largest")).unionByName(sizes.orderBy(by, key).limit(k).withColumn("tag", F.lit("smallest")))
