"""The attention cube over events: an event is a mention, its type a term, its user the author, a day a period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import attention as A
from tidemark.plans.registry import query, table

START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
LINKS = [("T1", "click"), ("T1", "view"), ("T2", "view"), ("T2", "purchase"), ("T3", "signup")]
#: scan_id, platform, channel, term, window start, window end, status, reported total
SCANS = [
    (1, "even", "main", "click", "2024-01-05", "2024-01-15", "complete", None),
    (2, "even", "main", "view", "2024-01-05", "2024-01-25", "complete", None),
    (3, "even", "main", "click", "2024-01-12", "2024-01-20", "truncated", 900),
    (4, "odd", "main", "view", "2024-01-08", "2024-01-20", "truncated", 40),
    (5, "odd", "main", "purchase", "2024-01-05", "2024-01-22", "complete", None),
    (6, "odd", "main", "signup", "2024-01-05", "2024-01-25", "failed", None),
    (7, "even", "main", "signup", "2024-01-10", "2024-01-12", "complete", None),
]
_values = lambda rows: ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)
ROLES = f"""
WITH links(topic_id, term_id) AS (VALUES {_values(LINKS)}),
scans(scan_id, platform, channel, term_id, ws, we, status, reported_total) AS (VALUES {_values(SCANS)}),
mentions AS (SELECT event_id AS mention_id, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS platform, 'main' AS channel, user_id, event_type, value, CAST(ts AS DATE) AS month
             FROM events WHERE CAST(ts AS DATE) >= DATE '{START}' AND CAST(ts AS DATE) < DATE '{END}'),
tm AS (SELECT DISTINCT topic_id, mention_id FROM links JOIN mentions ON term_id = event_type),
counted AS (SELECT topic_id, platform, channel, month, count(*) AS mentions, count(DISTINCT CASE WHEN user_id % 7 <> 0 THEN user_id END) AS authors, sum(CAST(floor(value) AS BIGINT))::BIGINT AS engagement
            FROM tm JOIN mentions USING (mention_id) GROUP BY ALL),
days AS (SELECT CAST(range AS DATE) AS month FROM range(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)),
cells AS (SELECT platform, channel, term_id, month, arg_max(status, scan_id) AS status, arg_max(coalesce(reported_total, -1), scan_id) AS total
          FROM scans JOIN days ON month >= ws::DATE AND month < we::DATE WHERE status IN ('complete', 'truncated') GROUP BY ALL),
spine AS (SELECT p.platform, 'main' AS channel, month FROM (VALUES ('even'), ('odd')) p(platform), days),
covered AS (SELECT topic_id, s.platform, s.channel, s.month, count(c.status) AS known, count(*) AS terms, count(*) FILTER (c.status = 'truncated') AS cut,
                   coalesce(max(CASE WHEN c.status = 'truncated' THEN greatest(c.total, 0) END), 0) AS truncated_total
            FROM links CROSS JOIN spine s LEFT JOIN cells c ON c.platform = s.platform AND c.channel = s.channel AND c.term_id = links.term_id AND c.month = s.month GROUP BY ALL),
volumes AS (SELECT platform, channel, month, count(*) AS total FROM mentions WHERE day(month) <> 9 GROUP BY ALL)
"""
COVERAGE = "CASE WHEN known = 0 THEN 'missing' WHEN known < terms THEN 'partial' WHEN cut > 0 THEN 'truncated' ELSE 'complete' END"
LINK_DDL, SCAN_DDL = "topic_id string, term_id string", "scan_id int, platform string, channel string, term_id string, window_start string, window_end string, status string, reported_total bigint"


def roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    links = spark.createDataFrame(LINKS, LINK_DDL)
    scans = spark.createDataFrame(SCANS, SCAN_DDL).withColumns({c: F.col(c).cast("date") for c in ("window_start", "window_end")})
    day = F.col("ts").cast("date")
    even = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    mentions = table(spark, sf_dir, "events").select(F.col("event_id").alias("mention_id"), even.alias("platform"), F.lit("main").alias("channel"), day.alias("created_at"), F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("author_hash"), F.floor("value").cast("bigint").alias("engagement"), "event_type")
    matched = mentions.select(F.col("event_type").alias("term_id"), "mention_id")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(START), F.date_sub(F.lit(END), 1))).alias("month"))
    spine = spark.createDataFrame([("even", "main"), ("odd", "main")], "platform string, channel string").crossJoin(days)
    inside = mentions.where((F.col("created_at") >= F.lit(START)) & (F.col("created_at") < F.lit(END)))
    volumes = inside.where(F.day("created_at") != 9).groupBy("platform", "channel", F.col("created_at").alias("month")).agg(F.count("*").alias("total"))
    periods = F.sequence(F.greatest("window_start", F.lit(START)), F.date_sub(F.least("window_end", F.lit(END)), 1))
    return {"links": links, "scans": scans, "mentions": mentions, "matched": matched, "spine": spine, "volumes": volumes, "cells": A.observed_cells(scans, periods)}


def _counted(r: dict[str, DataFrame]) -> DataFrame:
    return A.measures(r["links"], r["matched"], r["mentions"], F.col("created_at"), F.lit(START), F.lit(END))


@query("attention_cube", f"""{ROLES} SELECT topic_id, platform, channel, month, coalesce(mentions, 0) AS mentions, coalesce(authors, 0) AS authors, coalesce(engagement, 0)::BIGINT AS engagement,
 CASE WHEN known > 0 THEN greatest(coalesce(mentions, 0), truncated_total)::BIGINT END AS estimated, total AS volume,
 round(CASE WHEN known > 0 AND total <> 0 THEN greatest(coalesce(mentions, 0), truncated_total)::DOUBLE / total END, 6) AS share, {COVERAGE} AS coverage
 FROM covered LEFT JOIN counted USING (topic_id, platform, channel, month) LEFT JOIN volumes USING (platform, channel, month)""")
def attention_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roles(spark, sf_dir)
    out = A.cube(r["links"], _counted(r), A.coverage(r["links"], r["cells"], r["spine"]), r["volumes"])
    return out.withColumn("share", F.round("share", 6))


@query("agg06_attention_measures", f"{ROLES} SELECT * FROM counted")
def agg06_attention_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(roles(spark, sf_dir))


@query("agg08_coverage_states", f"{ROLES} SELECT topic_id, platform, channel, month, {COVERAGE} AS coverage, known, truncated_total::BIGINT AS truncated_total FROM covered")
def agg08_coverage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roles(spark, sf_dir)
    return A.coverage(r["links"], r["cells"], r["spine"])


@query("jn09_topic_mentions", f"{ROLES} SELECT topic_id, count(*) AS mentions FROM tm GROUP BY topic_id")
def jn09_topic_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roles(spark, sf_dir)
    inside = r["mentions"].where((F.col("created_at") >= F.lit(START)) & (F.col("created_at") < F.lit(END)))
    return A.topic_mentions(r["links"], r["matched"]).join(inside, "mention_id", "left_semi").groupBy("topic_id").agg(F.count("*").alias("mentions"))


@query("stm01_plan_windows", """WITH scans AS (SELECT n_name AS channel, c_mktsegment AS term_id, max(date_trunc('month', o_orderdate)::DATE) AS edge FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY ALL),
 terms AS (SELECT DISTINCT c_mktsegment AS term_id FROM customer), channels AS (SELECT DISTINCT n_name AS channel FROM nation),
 grid AS (SELECT channel, term_id, greatest(coalesce(edge, DATE '1996-01-01'), DATE '1996-01-01') AS window_start FROM channels CROSS JOIN terms LEFT JOIN scans USING (channel, term_id))
 SELECT channel, term_id, window_start, DATE '2001-07-01' AS window_end FROM grid WHERE window_start < DATE '2001-07-01'""")
def stm01_plan_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations are channels, market segments terms, orders scans up to their month; those not filled came from a split scan."""
    nations, customers = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 100000").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    scans = orders.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("channel"), F.col("c_mktsegment").alias("term_id"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("parent_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("window_end"),
    )
    return A.plan_windows(customers.select(F.col("c_mktsegment").alias("term_id")), nations.select(F.col("n_name").alias("channel")), scans, dt.date(1996, 1, 1), dt.date(2001, 7, 1))


@query("stm02_scan_status", """SELECT o_orderkey, CASE WHEN total > 150 AND span > 1 THEN 'split' WHEN (fetched >= 150 AND o_orderstatus = 'O' OR total > fetched) THEN CASE WHEN span > 1 THEN 'split' ELSE 'truncated' END ELSE 'complete' END AS status
 FROM (SELECT o_orderkey, o_orderstatus, CAST(floor(o_totalprice / 1000) AS BIGINT) AS total, least(CAST(floor(o_totalprice / 900) AS BIGINT), 180) AS fetched, CAST(o_custkey % 3 + 1 AS INTEGER) AS span FROM orders)""")
def stm02_scan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    total, fetched = F.floor(F.col("o_totalprice") / 1000), F.least(F.floor(F.col("o_totalprice") / 900), F.lit(180))
    return rows.select("o_orderkey", A.scan_status(total, fetched, F.col("o_orderstatus") == "O", 150, F.col("o_custkey") % 3 + 1).alias("status"))


@query("stm02_split_children", """WITH s AS (SELECT o_orderkey AS id, date_trunc('month', o_orderdate)::DATE AS ws, CAST(o_custkey % 5 + 2 AS INTEGER) AS n FROM orders),
 h AS (SELECT id, ws, (ws + to_months(n // 2))::DATE AS mid, (ws + to_months(n))::DATE AS we FROM s)
 SELECT id AS parent_id, ws AS window_start, mid AS window_end FROM h UNION ALL SELECT id, mid, we FROM h""")
def stm02_split_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    start = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    scans = orders.select(F.lit("p").alias("platform"), F.lit("c").alias("channel"), F.col("o_orderkey").cast("string").alias("term_id"), F.col("o_orderkey").alias("scan_id"), start.alias("window_start"), F.add_months(start, (F.col("o_custkey") % 5 + 2).cast("int")).alias("window_end"), F.lit("split").alias("status"))
    return A.split_children(scans).select("parent_id", "window_start", "window_end")


@query("stm06_missing_volumes", f"{ROLES} SELECT platform, channel, month FROM spine ANTI JOIN volumes USING (platform, channel, month)")
def stm06_missing_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roles(spark, sf_dir)
    return A.missing_volumes(r["spine"], r["volumes"])


@query("stm11_failure_streaks", """WITH o AS (SELECT user_id, event_id, event_type <> 'view' AND event_type <> 'click' AS ok FROM events),
 i AS (SELECT *, sum(ok::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM o), s AS (SELECT user_id, g, count(*) AS n FROM i WHERE NOT ok GROUP BY ALL),
 m AS (SELECT user_id, max(n) AS longest FROM s GROUP BY 1)
 SELECT user_id AS run_id, coalesce(longest, 0) AS longest, coalesce(longest, 0) >= 5 AS aborted FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN m USING (user_id)""")
def stm11_failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("position"), (~F.col("event_type").isin("view", "click")).alias("ok"))
    return A.failure_streaks(rows)


@query("flt12_runnable_scans", """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01') OR (o_orderstatus = 'F' AND o_custkey % 5 < 3 AND o_orderdate < TIMESTAMP '1996-01-01')""")
def flt12_runnable_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "claimed").when(F.col("o_orderstatus") == "F", "failed")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", named.alias("status"), F.col("o_orderdate").alias("lease_until"), (F.col("o_custkey") % 5).alias("attempts"), F.col("o_orderdate").alias("updated_at"))
    return rows.where(A.runnable(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz"))).select("o_orderkey")


@query("streaming_daily_attention", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS mentions, round(sum(value), 4) AS engagement FROM events GROUP BY ALL")
def streaming_daily_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, read to its end; the windows' states are written when it ends."""
    from tidemark.sources.durable import work_dir
    from tidemark.streaming.attention import daily_attention

    at = work_dir(spark, "stream")
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{at}/rows")
    started = daily_attention(stream).writeStream.outputMode("complete").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    started.awaitTermination()
    return spark.read.parquet(f"{at}/rows").select("event_type", "day", "mentions", F.round("engagement", 4).alias("engagement"))
