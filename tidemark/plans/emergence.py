"""Emergence over lineitem and part: a line is a work, its part's brand the topic, first lines of returned goods outliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import emergence as E
from tidemark.operators import topics as T
from tidemark.plans.registry import query, table

FIRST, LAST = dt.date(1995, 6, 15), dt.date(2000, 12, 31)


def roles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(works, assignments, topics)."""
    line = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("work_id"), "l_partkey", F.col("l_shipdate").cast("date").alias("published"), ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).alias("is_outlier"))
    line = line.where(F.col("published").between(F.lit(FIRST), F.lit(LAST)))
    part = table(spark, sf_dir, "part")
    members = line.join(part.select("p_partkey", F.col("p_brand").alias("topic")), F.col("l_partkey") == F.col("p_partkey"))
    return line.select("work_id", "published"), members.select("work_id", "topic", "is_outlier"), part.select(F.col("p_brand").alias("topic")).distinct()


#: The same roles in SQL, and the periods of the interval.
ROLES = f"""
WITH works AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS work_id, l_partkey, CAST(l_shipdate AS DATE) AS published,
                      l_returnflag = 'R' AND l_linenumber = 1 AS is_outlier
               FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
members AS (SELECT work_id, p_brand AS topic, published FROM works JOIN part ON l_partkey = p_partkey WHERE NOT is_outlier),
topics AS (SELECT DISTINCT p_brand AS topic FROM part),
years AS (SELECT range AS y FROM range(1996, 2001)),
yearly AS (SELECT t.topic, CAST(y AS INTEGER) AS year,
                  (SELECT count(*) FROM members m WHERE m.topic = t.topic AND year(m.published) = y) AS topic_count,
                  (SELECT count(*) FROM works w WHERE year(w.published) = y) AS corpus_count
           FROM topics t, years),
shared AS (SELECT *, CASE WHEN corpus_count > 0 THEN topic_count::DOUBLE / corpus_count END AS share FROM yearly),
pairs AS (SELECT *, CASE WHEN lead(year) OVER w = year + 1 AND share > 0 AND lead(share) OVER w > 0
                         THEN ln(lead(share) OVER w / share) END AS r FROM shared WINDOW w AS (PARTITION BY topic ORDER BY year)),
growth AS (SELECT topic, avg(share) AS mean_share, exp(avg(r)) - 1 AS annual_growth, count(r) AS pairs FROM pairs GROUP BY topic),
cut AS (SELECT median(mean_share) AS m FROM growth WHERE pairs > 0)
"""
MONTHS = f"""
months AS (SELECT CAST(range AS DATE) AS month FROM range(DATE '1995-06-01', DATE '2001-01-01', INTERVAL 1 MONTH)),
c AS (SELECT date_trunc('month', published)::DATE AS month, count(*) AS n FROM works GROUP BY 1),
k AS (SELECT topic, date_trunc('month', published)::DATE AS month, count(*) AS n FROM members GROUP BY 1, 2),
monthly AS (SELECT t.topic, m.month, coalesce(k.n, 0) AS topic_count, coalesce(c.n, 0) AS corpus_count,
                   CASE WHEN c.n > 0 THEN coalesce(k.n, 0)::DOUBLE / c.n END AS share
            FROM topics t CROSS JOIN months m LEFT JOIN c USING (month) LEFT JOIN k ON k.topic = t.topic AND k.month = m.month)
"""
QUADRANT = """CASE WHEN pairs = 0 THEN NULL WHEN mean_share >= m AND annual_growth > 0 THEN 'wisdom_strong'
 WHEN mean_share < m AND annual_growth > 0 THEN 'wisdom_weak' WHEN mean_share < m THEN 'latent' ELSE 'nswk' END"""


@query("emergence_quadrants", f"""{ROLES} SELECT topic, round(mean_share, 6) AS mean_share, round(CASE WHEN pairs = 0 THEN -1.0 ELSE annual_growth END, 6) AS annual_growth,
 pairs AS valid_year_pair_count, CASE WHEN pairs > 0 THEN 'scored' ELSE 'newly_observed' END AS coverage_status, {QUADRANT} AS emergence_quadrant FROM growth, cut""")
def emergence_quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    works, assignments, topics = roles(spark, sf_dir)
    out = E.quadrants(E.annual_growth(E.yearly_series(works, assignments, topics, FIRST, LAST)))
    return out.select("topic", F.round("mean_share", 6).alias("mean_share"), F.round("annual_growth", 6).alias("annual_growth"), "valid_year_pair_count", "coverage_status", "emergence_quadrant")


@query("emergence_observe", f"""{ROLES}, {MONTHS}, full_months AS (SELECT * FROM monthly WHERE month >= DATE '1995-07-01'),
ch AS (SELECT *, CASE WHEN share > 0 AND lead(share) OVER w > 0 THEN ln(lead(share) OVER w / share) END AS r FROM full_months WINDOW w AS (PARTITION BY topic ORDER BY month)),
change AS (SELECT topic, exp(avg(r)) - 1 AS v FROM ch GROUP BY topic)
SELECT topic, round(v, 6) AS monthly_share_change, (SELECT string_agg(strftime(month, '%Y-%m') || ':' || topic_count || '/' || corpus_count, ',' ORDER BY month) FROM monthly x WHERE x.topic = g.topic) AS series,
 {QUADRANT} AS emergence_quadrant FROM growth g JOIN change USING (topic), cut""")
def emergence_observe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.observe(*roles(spark, sf_dir), FIRST, LAST)
    point = F.transform("monthly_series", lambda x: F.concat(x["year_month"], F.lit(":"), x["topic_count"].cast("string"), F.lit("/"), x["corpus_count"].cast("string")))
    return out.select("topic", F.round("monthly_share_change", 6).alias("monthly_share_change"), F.array_join(point, ",").alias("series"), "emergence_quadrant")


@query("agg11_monthly_series", f"{ROLES}, {MONTHS} SELECT topic, month, topic_count, corpus_count, round(share, 6) AS share FROM monthly")
def agg11_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.monthly_series(*roles(spark, sf_dir), FIRST, LAST).select("topic", "month", "topic_count", "corpus_count", F.round("share", 6).alias("share"))


@query("agg12_yearly_share", f"{ROLES} SELECT topic, year, topic_count, corpus_count, round(share, 6) AS share FROM shared")
def agg12_yearly_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.yearly_series(*roles(spark, sf_dir), FIRST, LAST).select("topic", "year", "topic_count", "corpus_count", F.round("share", 6).alias("share"))


@query("agg14_geo_growth", f"{ROLES} SELECT topic, round(annual_growth, 6) AS annual_growth, pairs AS valid_year_pair_count, round(mean_share, 6) AS mean_share FROM growth")
def agg14_geo_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.annual_growth(E.yearly_series(*roles(spark, sf_dir), FIRST, LAST))
    return out.select("topic", F.round("annual_growth", 6).alias("annual_growth"), "valid_year_pair_count", F.round("mean_share", 6).alias("mean_share"))


@query("agg14_monthly_change", f"""{ROLES}, {MONTHS}, ch AS (SELECT *, CASE WHEN share > 0 AND lead(share) OVER w > 0 THEN ln(lead(share) OVER w / share) END AS r
 FROM monthly WHERE month >= DATE '1995-07-01' WINDOW w AS (PARTITION BY topic ORDER BY month)) SELECT topic, round(exp(avg(r)) - 1, 6) AS monthly_share_change FROM ch GROUP BY topic""")
def agg14_monthly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.monthly_share_change(E.monthly_series(*roles(spark, sf_dir), FIRST, LAST), FIRST, LAST)
    return out.select("topic", F.round("monthly_share_change", 6).alias("monthly_share_change"))


@query("agg15_median_share", f"{ROLES} SELECT round(m, 6) AS median_share FROM cut")
def agg15_median_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.annual_growth(E.yearly_series(*roles(spark, sf_dir), FIRST, LAST))
    return out.where("valid_year_pair_count > 0").agg(F.round(F.median("mean_share"), 6).alias("median_share"))


@query("agg16_run_status", f"{ROLES} SELECT string_agg(DISTINCT CASE WHEN pairs > 0 THEN 'scored' ELSE 'newly_observed' END, ',') AS coverage_status FROM growth")
def agg16_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.run_status(E.quadrants(E.annual_growth(E.yearly_series(*roles(spark, sf_dir), FIRST, LAST))))


@query("agg21_outlier_rate", f"{ROLES} SELECT count(*) AS works, count(*) FILTER (is_outlier) AS outliers, round(avg(is_outlier::INT), 6) AS outlier_rate FROM works")
def agg21_outlier_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.outlier_rate(roles(spark, sf_dir)[1]).select("works", "outliers", F.round("outlier_rate", 6).alias("outlier_rate"))


@query("agg22_composition_hash", f"{ROLES} SELECT topic, count(*) AS size, sha256(string_agg(work_id, chr(10) ORDER BY work_id)) AS composition_hash FROM members GROUP BY topic")
def agg22_composition_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.composition(roles(spark, sf_dir)[1].where("not is_outlier"))


@query("jn12_missing_works", f"{ROLES} SELECT topic, count(*) AS lost FROM members WHERE work_id NOT IN (SELECT work_id FROM works WHERE year(published) < 2000) GROUP BY topic")
def jn12_missing_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    works, assignments, _ = roles(spark, sf_dir)
    return assignments.where("not is_outlier").join(works.where(F.year("published") < 2000), "work_id", "left_anti").groupBy("topic").agg(F.count("*").alias("lost"))


@query("win03_adjacent_years", f"{ROLES} SELECT topic, year, round(exp(r), 6) AS ratio FROM pairs WHERE r IS NOT NULL")
def win03_adjacent_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window as W

    w = W.partitionBy("topic").orderBy("year")
    rows = E.yearly_series(*roles(spark, sf_dir), FIRST, LAST)
    rows = rows.withColumn("r", E.log_ratio(F.col("year") + 1 == F.lead("year").over(w), F.lead("share").over(w)))
    return rows.where("r is not null").select("topic", "year", F.round(F.exp("r"), 6).alias("ratio"))
