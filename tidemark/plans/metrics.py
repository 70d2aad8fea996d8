"""Metrics by topic and country, profiles, top-k, set operations, over orders, lineitem, part, nation and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import catalog as K
from tidemark.operators import metrics as M
from tidemark.plans.registry import query, table

MONTHLY = """WITH m AS (SELECT p_brand AS topic, date_trunc('month', l_shipdate)::DATE AS month, count(*) AS works, count(*) FILTER (l_returnflag = 'N') AS preprints, sum(CAST(l_quantity AS BIGINT))::BIGINT AS citations,
 count(*) FILTER (l_linenumber = 1) AS funded, count(DISTINCT l_suppkey) AS authors FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works, preprints, citations, funded works and authors per topic and month: our reading of the six monthly metrics."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rows = line.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    return rows.groupBy(F.col("p_brand").alias("topic"), month.alias("month")).agg(F.count("*").alias("works"), F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("preprints"), F.sum(F.col("l_quantity").cast("bigint")).alias("citations"), F.count(F.when(F.col("l_linenumber") == 1, 1)).alias("funded"), F.countDistinct("l_suppkey").alias("authors"))


@query("agg24_monthly_shares", f"{MONTHLY} SELECT topic, month, works, authors, round(100.0 * preprints / works, 6) AS preprint_share_pct, round(citations / works, 6) AS citations_per_work, round(100.0 * funded / works, 6) AS funded_works_share_pct FROM m")
def agg24_monthly_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.shares(monthly(spark, sf_dir))
    return out.select("topic", "month", "works", "authors", *(F.round(c, 6).alias(c) for c in ("preprint_share_pct", "citations_per_work", "funded_works_share_pct")))


@query("agg24_topic_summary", f"{MONTHLY} SELECT topic, sum(works)::BIGINT AS works_sum, sum(citations)::BIGINT AS citations_sum, round(avg(authors), 6) AS authors_mean FROM m GROUP BY topic")
def agg24_topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.summary(monthly(spark, sf_dir), ["works", "citations"], ["authors"]).withColumn("authors_mean", F.round("authors_mean", 6))


@query("agg29_total_citations", f"{MONTHLY} SELECT topic, sum(citations)::BIGINT AS citations FROM m GROUP BY topic")
def agg29_total_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly(spark, sf_dir).groupBy("topic").agg(F.sum("citations").alias("citations"))


def _by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("n_name").alias("country"), F.col("o_orderpriority").alias("topic"), F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"), F.lit(1).alias("works"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
COUNTRY = "WITH b AS (SELECT n_name AS country, o_orderpriority AS topic, date_trunc('month', o_orderdate)::DATE AS month FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), best AS (SELECT country FROM b GROUP BY 1 ORDER BY count(*) DESC, country LIMIT 10)"


@query("agg25_pivot_countries", COUNTRY + " SELECT country, " + ", ".join(f"count(*) FILTER (topic = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM b GROUP BY country")
def agg25_pivot_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pivot_counts(_by_country(spark, sf_dir), "country", "topic", PRIORITIES, "works")


@query("top06_top_countries", f"{COUNTRY} SELECT country, month, count(*) AS works FROM b WHERE country IN (SELECT country FROM best) GROUP BY ALL")
def top06_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.within_top(_by_country(spark, sf_dir), "country", "works", 10).groupBy("country", "month").agg(F.count("*").alias("works"))


@query("agg26_length_histogram", "SELECT lang, least(greatest(CAST(floor(length(text) / 500.0) AS BIGINT) + 1, 0), 21) AS bin, count(*) AS n FROM documents GROUP BY ALL")
def agg26_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang", M.histogram(F.length("text").cast("double"), 0.0, 10000.0, 20).alias("bin")).agg(F.count("*").alias("n"))


@query("agg05_works_per_topic", "SELECT p_brand AS topic_id, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def agg05_works_per_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_brand").alias("topic_id")).agg(F.countDistinct("l_orderkey").alias("n"))


@query("top02_select_topics", "SELECT p_brand AS topic_id, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, 1 LIMIT 7")
def top02_select_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.select_topics(agg05_works_per_topic(spark, sf_dir), 7)


@query("flt08_explicit_topics", "SELECT p_brand AS topic_id, count(*) AS n FROM part WHERE p_brand IN ('Brand#12', 'Brand#31', 'Brand#99') GROUP BY 1")
def flt08_explicit_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("topic_id")).agg(F.count("*").alias("n"))
    return K.select_topics(counts, 3, ["Brand#31", "Brand#12", "Brand#99"])


@query("top03_latest_run", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def top03_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return rows.select("o_custkey", "m.o_orderkey", "m.o_orderdate")


@query("top05_extremes", """WITH s AS (SELECT p_brand AS topic, count(*) AS n FROM part GROUP BY 1) SELECT * FROM (SELECT topic, n, 'largest' AS tag FROM s ORDER BY n DESC, topic LIMIT 5) UNION ALL SELECT * FROM (SELECT topic, n, 'smallest' AS tag FROM s ORDER BY n, topic LIMIT 5)""")
def top05_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.extremes(table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("topic")).agg(F.count("*").alias("n")), "n", "topic")


@query("jn10_topics_and_labels", "SELECT p_brand AS topic, count(*) AS parts, count(s_suppkey) AS labelled FROM part LEFT JOIN supplier ON s_suppkey = p_partkey AND s_acctbal > 0 GROUP BY 1")
def jn10_topics_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("p_partkey"), "s_suppkey")
    return table(spark, sf_dir, "part").join(named, "p_partkey", "left").groupBy(F.col("p_brand").alias("topic")).agg(F.count("*").alias("parts"), F.count("s_suppkey").alias("labelled"))


@query("jn13_plan_misses", "SELECT count(*) FILTER (NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)) AS misses, count(*) FILTER (EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)) AS hits FROM documents d")
def jn13_plan_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, cached = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(1).alias("hit"))
    return docs.join(cached.distinct(), "doc_id", "left").agg(F.count(F.when(F.col("hit").isNull(), 1)).alias("misses"), F.count("hit").alias("hits"))


@query("set02_id_sets", "SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS shared, (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS unlabelled")
def set02_id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    return a.intersect(b).agg(F.count("*").alias("shared")).crossJoin(a.subtract(b).agg(F.count("*").alias("unlabelled")))


@query("set01_tagged_union", "SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier")
def set01_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))


@query("jn17_payload_elements", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) BETWEEN 10 AND 40 GROUP BY 1")
def jn17_payload_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").select(F.explode(F.from_json("props", "map<string,bigint>")).alias("name", "k"))
    return pairs.where("name = 'k' AND k BETWEEN 10 AND 40").groupBy("k").agg(F.count("*").alias("n"))


@query("jn16_latest_bundle", "SELECT event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1")
def jn16_latest_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


@query("jn08_baseline_chunks", "SELECT c_mktsegment, count(*) AS customers, sum(coalesce(n, 0))::BIGINT AS orders FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE r_name = 'ASIA' GROUP BY 1")
def jn08_baseline_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    asia = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(F.col("n_nationkey").alias("c_nationkey"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(asia), "c_nationkey", "left_semi").join(chunks, "c_custkey", "left")
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.sum(F.coalesce("n", F.lit(0))).alias("orders"))


@query("agg32_label_counts", "SELECT count(DISTINCT label) AS topics, count(*) FILTER (label < 5) AS succeeded, count(*) FILTER (label >= 5) AS failed FROM embeddings")
def agg32_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").agg(F.countDistinct("label").alias("topics"), F.count(F.when(F.col("label") < 5, 1)).alias("succeeded"), F.count(F.when(F.col("label") >= 5, 1)).alias("failed"))


@query("agg07_covered_boundary", "SELECT event_type, user_id % 10 AS channel, max(CAST(ts AS DATE)) AS edge FROM events WHERE event_id % 4 <> 0 GROUP BY ALL")
def agg07_covered_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_id % 4 <> 0").groupBy("event_type", (F.col("user_id") % 10).alias("channel")).agg(F.max(F.col("ts").cast("date")).alias("edge"))


@query("flt09_profile_terms", """WITH p AS (SELECT p_partkey % 50 AS topic_id, p_partkey AS position, trim(regexp_replace(replace(p_name, '"', ' '), '\\s+', ' ', 'g')) AS term, CASE WHEN p_partkey % 3 = 0 THEN 'display_name' ELSE 'keyword' END AS origin FROM part),
 n AS (SELECT *, trim(regexp_replace(lower(term), '[^a-z0-9]+', ' ', 'g')) AS normalized FROM p)
 SELECT topic_id, sha256('term-v1' || chr(10) || normalized) AS term_id, arg_min(term, position) AS term, normalized, arg_min(origin, position) AS origin FROM n WHERE length(normalized) >= 4 AND normalized <> 'part 7' GROUP BY topic_id, normalized""")
def flt09_profile_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("topic_id"), F.col("p_partkey").alias("position"), F.col("p_name").alias("phrase"), F.when(F.col("p_partkey") % 3 == 0, "display_name").otherwise("keyword").alias("origin"))
    return K.profile_terms(phrases, ["part 7"], 4)


@query("flt10_specific_terms", "SELECT p_partkey FROM part WHERE p_partkey % 3 = 0 OR len(string_split(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')), ' ')) >= 2")
def flt10_specific_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.text import normalize

    terms = table(spark, sf_dir, "part").select("p_partkey", normalize(F.col("p_type")).alias("normalized"), F.when(F.col("p_partkey") % 3 == 0, "display_name").otherwise("keyword").alias("origin"))
    return K.specific_terms(terms).select("p_partkey")
