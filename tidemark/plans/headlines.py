"""Funding headlines built from customers, parts and orders by templates, so that SQL knows what each must yield."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import funding as U
from tidemark.plans.registry import query, table
from tidemark.sources.durable import spread

#: One template for each c_custkey % 8; {name} is the customer, {n} a number from 10 to 99.
TEMPLATES = (
    "{name} nabs £{n} million in a bridge round led by Fern Capital",
    "{name} buys rival workshop for ¥{n}bn",
    "{name} wins regional grant worth ₹{n}k",
    "{name} goes public after a quiet year",
    "Outlook for {name} and its peers",
    "Артель «{name}» получила {n} тыс долл на посевном раунде",
    "«{name}» выиграла грант",
    "{name} opens a second office",
)


def _filled(template: str, name: Column, n: Column) -> Column:
    parts = [F.lit(template)]
    for key, value in (("{name}", name), ("{n}", n.cast("string"))):
        parts = [F.replace(parts[0], F.lit(key), value)]
    return parts[0]


def _headline(name: Column, n: Column, k: Column) -> Column:
    return F.element_at(F.array(*(_filled(t, name, n) for t in TEMPLATES)), k + 1)


@query("str11_extract_events", """SELECT c_custkey, CASE WHEN k IN (0, 5) THEN 'vc_round' WHEN k = 1 THEN 'm_and_a' WHEN k IN (2, 6) THEN 'grant' WHEN k = 3 THEN 'ipo' END AS event_type, CASE WHEN k NOT IN (4, 7) THEN c_name END AS company, CASE k WHEN 0 THEN 'bridge' WHEN 5 THEN 'seed' END AS stage,
 (n * CASE k WHEN 0 THEN 1e6 WHEN 1 THEN 1e9 WHEN 2 THEN 1e3 WHEN 5 THEN 1e3 END)::DOUBLE AS amount, CASE k WHEN 0 THEN 'GBP' WHEN 1 THEN 'JPY' WHEN 2 THEN 'INR' WHEN 5 THEN 'USD' END AS currency, CASE k WHEN 0 THEN 'Fern Capital' END AS investors
 FROM (SELECT c_custkey, c_name, c_custkey % 8 AS k, c_custkey % 90 + 10 AS n FROM customer)""")
def str11_extract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", _headline(F.col("c_name"), F.col("c_custkey") % 90 + 10, (F.col("c_custkey") % 8).cast("int")).alias("title"))
    return rows.select("c_custkey", U.extract(F.col("title")).alias("e")).select("c_custkey", "e.*")


@query("str12_reprint_groups", "SELECT 'House ' || o_custkey AS company, (o_orderkey % 3 + 1) * 1e5::DOUBLE AS amount, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS articles FROM orders GROUP BY ALL")
def str12_reprint_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two wordings of one event in a month are one event; another sum or month makes another."""
    house, sum_ = F.concat(F.lit("House "), "o_custkey"), (F.col("o_orderkey") % 3 + 1).cast("string")
    short = F.concat(house, F.lit(" raises $"), sum_, F.lit("00k in a seed round"))
    long = F.concat(house, F.lit(" secures $"), sum_, F.lit("00 thousand of seed funding"))
    articles = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("article_id"), F.when(F.col("o_orderkey") % 2 == 0, short).otherwise(long).alias("title"), F.col("o_orderdate").alias("seen_at"))
    events, links = U.events(articles)
    counts = links.groupBy("event_id").agg(F.count("*").alias("articles"))
    return counts.join(events, "event_id").select("company", "amount", "month", "articles")


@query("str08_clean_headlines", "SELECT p_partkey, replace(p_name, ' ', '-') || ' (' || p_size || '.5) costs $7250!' AS cleaned FROM part")
def str08_clean_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.replace("p_name", F.lit(" "), F.lit(" -  ")), F.lit(" ( "), F.col("p_size").cast("string"), F.lit(" . 5 ) costs $ 7 , 250 ! | Shop"))
    return table(spark, sf_dir, "part").select("p_partkey", U.clean(raw).alias("cleaned"))


@query("str09_amounts", """SELECT p_partkey, (CASE p_partkey % 6 WHEN 0 THEN p_size * 1e3 WHEN 1 THEN p_size * 1e9 WHEN 2 THEN (p_size + 0.5) * 1e6 WHEN 3 THEN p_size WHEN 5 THEN 2 END)::DOUBLE AS amount,
 CASE p_partkey % 6 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'INR' WHEN 5 THEN 'USD' END AS currency FROM part""")
def str09_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    raw = F.element_at(F.array(F.concat(F.lit("for €"), n, F.lit("k")), F.concat(F.lit("USD "), n, F.lit(" billion")), F.concat(F.lit("GBP"), n, F.lit(".5 mn")), F.concat(F.lit("₹"), n), F.lit("no sum named"), F.concat(F.lit("US$ 2 and €"), n)), (F.col("p_partkey") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select("p_partkey", U._amount(raw, U.ENGLISH).alias("m"))
    return rows.select("p_partkey", F.col("m.amount").alias("amount"), F.col("m.currency").alias("currency"))


@query("str10_companies", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS company FROM part")
def str10_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(F.concat(F.lit("Note: "), "p_name", F.lit(" bags a prize")), F.concat(F.lit("слово «"), "p_name", F.lit("» и дело")), F.concat(F.lit("one of the many makers of "), "p_name", F.lit(" raises money")), F.col("p_name")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", U._company(raw, U.ENGLISH).alias("company"))
