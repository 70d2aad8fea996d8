"""Corpus, versions and reconciliation over orders, lineitem, part and events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import corpus as C
from tidemark.operators import versions as V
from tidemark.plans.registry import query, table

RULES = C.CorpusRules(dt.date(1996, 1, 1), dt.date(1999, 12, 31), ("ECONOMY", "STANDARD", "PROMO"), ("3",))
INVERTED = "CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN '{}' ELSE '{\"alpha\":[0,2],\"beta\":[' || p_size::VARCHAR || ']}' END"


def _kind() -> F.Column:
    return F.split("p_type", " ")[0]


def roles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(current, versions): an order is an entity, its suppliers' lines the versions."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    version = (F.col("l_orderkey") * 100 + F.col("l_partkey") % 3).alias("version_id")
    current = line.select(F.col("l_orderkey").alias("entity_id"), version)
    inverted = F.when(F.col("p_size") % 5 == 0, None).when(F.col("p_size") % 7 == 0, "{}").otherwise(F.concat(F.lit('{"alpha":[0,2],"beta":['), F.col("p_size").cast("string"), F.lit("]}")))
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(version, F.col("p_type").alias("kind"), F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd").alias("published"), F.when(F.col("p_size") % 6 != 0, (F.col("p_size") % 6).cast("string")).alias("domain"), F.when(F.col("p_size") % 4 != 0, F.col("p_name")).alias("title"), inverted.alias("inverted"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"))
    versions = rows.groupBy("version_id").agg(F.min_by(F.struct("kind", "published", "domain", "title", "inverted"), "o").alias("v")).select("version_id", "v.*")
    return current, versions


ROLES = f"""
WITH lv AS (SELECT l_orderkey AS entity_id, l_orderkey * 100 + l_partkey % 3 AS version_id, l_linenumber, l_partkey, l_suppkey, p_type AS kind, strftime(l_shipdate, '%Y-%m-%d') AS published,
 CASE WHEN p_size % 6 <> 0 THEN (p_size % 6)::VARCHAR END AS domain, CASE WHEN p_size % 4 <> 0 THEN p_name END AS title, {INVERTED} AS inverted
 FROM lineitem JOIN part ON l_partkey = p_partkey),
versions AS (SELECT * FROM lv QUALIFY row_number() OVER (PARTITION BY version_id ORDER BY l_linenumber, l_partkey, l_suppkey) = 1),
one AS (SELECT entity_id, min(version_id) AS version_id, min(version_id) <> max(version_id) AS several FROM lv GROUP BY 1),
judged AS (SELECT o.entity_id, o.version_id, kind, published, domain, title, CASE WHEN several THEN 'version_conflict' WHEN kind NOT IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'work_type'
 WHEN published < '1996-01-01' OR published > '1999-12-31' THEN 'publication_date' WHEN domain = '3' THEN 'excluded_domain' WHEN inverted IS NULL OR inverted = '{{}}' THEN 'missing_abstract' END AS reason FROM one o JOIN versions v ON o.version_id = v.version_id)
"""


@query("agg04_coverage_ledger", f"""{ROLES} SELECT count(*) AS considered, count(*) FILTER (reason IS NULL) AS selected, count(*) FILTER (reason = 'version_conflict') AS version_conflict, count(*) FILTER (reason = 'work_type') AS work_type,
 count(*) FILTER (reason = 'publication_date') AS publication_date, count(*) FILTER (reason = 'excluded_domain') AS excluded_domain, count(*) FILTER (reason = 'missing_abstract') AS missing_abstract,
 count(*) FILTER (reason IS NULL AND domain IS NULL) AS unknown_domain, count(*) FILTER (reason IS NULL AND coalesce(title, '') = '') AS missing_title, true AS balanced FROM judged""")
def agg04_coverage_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.ledger(C.judged(*roles(spark, sf_dir), RULES))


@query("flt04_exclusion_reasons", f"{ROLES} SELECT coalesce(reason, 'selected') AS reason, count(*) AS n FROM judged GROUP BY 1")
def flt04_exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.judged(*roles(spark, sf_dir), RULES).groupBy(F.coalesce("reason", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n"))


@query("top01_manifest", f"""{ROLES} SELECT entity_id, version_id, title, (SELECT string_agg(w, ' ' ORDER BY p, w) FROM (VALUES (0, 'alpha'), (2, 'alpha'), (sz, 'beta')) t(p, w)) AS abstract, published, domain
 FROM (SELECT j.*, v.inverted, CAST(regexp_extract(v.inverted, 'beta":\\[(\\d+)', 1) AS INTEGER) AS sz FROM judged j JOIN versions v ON j.version_id = v.version_id WHERE reason IS NULL)""")
def top01_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.manifest(C.judged(*roles(spark, sf_dir), RULES))


@query("agg01_unique_current", f"{ROLES} SELECT entity_id, version_id FROM one WHERE NOT several")
def agg01_unique_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unique_current(roles(spark, sf_dir)[0])


@query("agg02_conflicts", f"{ROLES} SELECT entity_id, string_agg(DISTINCT version_id::VARCHAR, ',' ORDER BY version_id::VARCHAR) AS version_ids FROM lv GROUP BY 1 HAVING count(DISTINCT version_id) > 1")
def agg02_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = V.conflicts(roles(spark, sf_dir)[0])
    return found.select("entity_id", F.array_join(F.sort_array(F.transform("version_ids", lambda x: x.cast("string"))), ",").alias("version_ids"))


@query("agg03_filtered_counts", f"{ROLES} SELECT count(*) FILTER (kind NOT IN ('ECONOMY', 'STANDARD', 'PROMO')) AS wrong_type, count(*) FILTER (kind IN ('ECONOMY', 'STANDARD', 'PROMO') AND (published < '1996-01-01' OR published > '1999-12-31')) AS wrong_date FROM versions")
def agg03_filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles(spark, sf_dir)[1].withColumn("reason", C.exclusion(RULES, F.col("kind"), F.col("published"), F.col("domain")))
    return rows.agg(F.count(F.when(F.col("reason") == "work_type", 1)).alias("wrong_type"), F.count(F.when(F.col("reason") == "publication_date", 1)).alias("wrong_date"))


@query("jn01_current_versions", f"{ROLES} SELECT kind, count(*) AS n, count(DISTINCT lv.entity_id) AS entities FROM (SELECT DISTINCT entity_id, version_id FROM lv) lv JOIN (SELECT version_id, kind FROM versions) v USING (version_id) GROUP BY kind")
def jn01_current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, versions = roles(spark, sf_dir)
    return current.distinct().join(versions, "version_id").groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("entities"))


@query("jn05_without_conflicts", f"{ROLES} SELECT count(*) AS n FROM lv WHERE entity_id NOT IN (SELECT entity_id FROM one WHERE several)")
def jn05_without_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, _ = roles(spark, sf_dir)
    return current.join(V.conflicts(current), "entity_id", "left_anti").agg(F.count("*").alias("n"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as observations of an entity: some without a readable instant, some from an interface."""
    line = table(spark, sf_dir, "lineitem")
    day = F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd")
    updated = F.when(F.col("l_partkey") % 11 == 0, None).when(F.col("l_partkey") % 13 == 0, "not-a-date").when(F.col("l_suppkey") % 2 == 0, F.concat(day, F.lit("T01:00:00+02:00"))).otherwise(day)
    return line.select(F.col("l_linestatus").alias("scope_id"), F.col("l_orderkey").alias("entity_id"), F.col("l_suppkey").alias("version_id"), updated.alias("updated_date"), (F.col("l_quantity") > 25).alias("is_api"), F.col("l_linenumber").alias("observed_at"))


OBSERVED = """WITH o AS (SELECT l_linestatus AS scope_id, l_orderkey AS entity_id, l_suppkey AS version_id, l_quantity > 25 AS is_api, l_linenumber AS observed_at,
 CASE WHEN l_partkey % 11 = 0 OR l_partkey % 13 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) - INTERVAL 1 HOUR ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS instant FROM lineitem),
m AS (SELECT *, max(instant) OVER (PARTITION BY scope_id, entity_id) AS top FROM o)"""


@query("win02_reconciliation", f"""{OBSERVED}, best AS (SELECT * FROM m WHERE instant IS NULL OR instant = top QUALIFY row_number() OVER (PARTITION BY scope_id, entity_id ORDER BY is_api DESC, observed_at DESC, version_id DESC) = 1)
 SELECT b.scope_id, b.entity_id, b.version_id, s.versions, s.versions > 1 AS conflict, s.uncertain FROM best b JOIN (SELECT scope_id, entity_id, count(DISTINCT version_id) AS versions, bool_or(instant IS NULL) AS uncertain FROM o GROUP BY ALL) s USING (scope_id, entity_id)""")
def win02_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.reconcile(observations(spark, sf_dir)).select("scope_id", "entity_id", "version_id", F.size("version_ids").cast("bigint").alias("versions"), "conflict", "uncertain")


@query("win01_latest_per_key", "SELECT l_linestatus, l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_linestatus, l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC, l_linenumber DESC) = 1")
def win01_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.latest(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_orderkey"], "l_shipdate", "l_suppkey", "l_linenumber").select("l_linestatus", "l_orderkey", "l_linenumber", "l_suppkey")


@query("jn02_page_time", "SELECT l_orderkey, l_linenumber, coalesce(e.t, l_shipdate) AS observed_at FROM lineitem LEFT JOIN (SELECT user_id AS u, event_id % 50 AS k, max(ts) AS t FROM events GROUP BY ALL) e ON e.u = l_partkey % 200 AND e.k = l_suppkey % 50")
def jn02_page_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 200).alias("run_id"), (F.col("l_suppkey") % 50).alias("source_id"), F.col("l_shipdate").alias("observed_at"))
    pages = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), (F.col("event_id") % 50).alias("source_id"), F.col("ts").alias("ended_at"))
    return V.with_page_time(line, pages).select("l_orderkey", "l_linenumber", "observed_at")


@query("jn04_unprocessed", "SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_custkey % 7 = l.l_linenumber)")
def jn04_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7).cast("int").alias("l_linenumber"))
    return V.unprocessed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), done, ["l_orderkey", "l_linenumber"])


@query("jn03_enqueue_claims", "SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def jn03_enqueue_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return V.unprocessed(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query("jn06_semi_profile", "SELECT count(*) AS n FROM events WHERE event_type IN (SELECT 'click' UNION ALL SELECT 'view') AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def jn06_semi_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).join(chosen, "user_id", "left_semi").agg(F.count("*").alias("n"))


@query("win09_row_offsets", """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) + coalesce((SELECT max(event_id % 97) + 1 FROM events k WHERE k.user_id = e.user_id AND k.event_type = 'error'), 1) - 1 AS row_number FROM events e WHERE event_type <> 'error'""")
def win09_row_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("run_id", F.col("user_id"))
    known = rows.where("event_type = 'error'").select("run_id", (F.col("event_id") % 97).alias("row_number"))
    return V.row_offsets(rows.where("event_type <> 'error'").select("run_id", "event_id"), known, ["event_id"]).select("event_id", "row_number")


SCOPE = C.Scope(dt.date(1996, 1, 1), dt.date(1999, 12, 31), domains=("1", "2", "4"), not_fields=("7",))


def _disposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    published = F.when(F.col("l_partkey") % 17 == 0, "1996-13-01").when(F.col("l_partkey") % 19 == 0, None).otherwise(F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd"))
    expansion = F.when(F.col("l_suppkey") % 10 == 0, None).otherwise(F.col("l_returnflag") == "R")
    identity = F.when(F.col("l_linenumber") == 7, "").otherwise("w")
    domain, field = F.when(F.col("l_linenumber") != 6, (F.col("l_suppkey") % 5).cast("string")), F.when(F.col("l_linenumber") != 5, (F.col("l_partkey") % 9).cast("string"))
    return line.select("l_orderkey", "l_linenumber", SCOPE.disposition(published, expansion, identity, domain, field).alias("disposition"))


DISPOSED = """WITH d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 = 0 OR l_partkey % 19 = 0 THEN 'quarantine:publication_date' WHEN l_suppkey % 10 = 0 THEN 'quarantine:corpus_flag'
 WHEN l_returnflag = 'R' THEN 'excluded:expansion' WHEN CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN 'excluded:date' WHEN l_linenumber = 7 THEN 'quarantine:identity'
 WHEN l_linenumber = 6 OR l_suppkey % 5 NOT IN (1, 2, 4) OR (l_linenumber <> 5 AND l_partkey % 9 = 7) THEN 'excluded:classification' ELSE 'selected' END AS disposition FROM lineitem)"""


@query("flt01_disposition", f"{DISPOSED} SELECT * FROM d")
def flt01_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _disposed(spark, sf_dir)


@query("agg23_disposition_counts", f"{DISPOSED} SELECT split_part(disposition, ':', 1) AS kind, count(*) AS n FROM d GROUP BY 1")
def agg23_disposition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.disposition_counts(_disposed(spark, sf_dir))


@query("flt13_quarantine_view", f"{DISPOSED} SELECT * FROM d WHERE starts_with(disposition, 'quarantine:')")
def flt13_quarantine_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _disposed(spark, sf_dir).where(F.startswith("disposition", F.lit("quarantine:")))
