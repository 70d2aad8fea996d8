"""Ingest: gaps, packing, progress, queues, files, manifests, taxonomy checks, sinks as values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import catalog as K
from tidemark.operators import packing as P
from tidemark.plans.registry import query, table
from tidemark.sources import file_index, row_groups, sinks
from tidemark.sources import files as S
from tidemark.sources.durable import work_dir


def _ranges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A customer is a file of 100 rows; every order commits three rows at a place of its own."""
    orders = table(spark, sf_dir, "orders")
    start = (F.col("o_orderkey") % 30 * 3).alias("start")
    ranges = orders.select(F.col("o_custkey").alias("file"), start, F.lit(3).cast("bigint").alias("count")).distinct()
    return ranges, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file"), F.lit(100).cast("bigint").alias("total"))


RANGES = """WITH r AS (SELECT DISTINCT o_custkey AS file, o_orderkey % 30 * 3 AS s FROM orders), g AS (
 SELECT file, coalesce(lag(s) OVER (PARTITION BY file ORDER BY s) + 3, 0) AS gap_start, s AS gap_end FROM r WHERE file IN (SELECT c_custkey FROM customer)
 UNION ALL SELECT c_custkey, coalesce((SELECT max(s) + 3 FROM r WHERE file = c_custkey), 0), 100 FROM customer)"""


@query("win04_coverage_gaps", f"{RANGES} SELECT * FROM g WHERE gap_start < gap_end")
def win04_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.coverage_gaps(*_ranges(spark, sf_dir))


@query("agg31_baseline_completeness", f"{RANGES} SELECT (SELECT count(*) FROM customer) AS files, (SELECT count(DISTINCT file) FROM g WHERE gap_start < gap_end) AS incomplete")
def agg31_baseline_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.files_with_gaps(*_ranges(spark, sf_dir))


PACKED = """WITH RECURSIVE r AS (SELECT {key} AS file, {order} AS o, {size} AS s, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS i FROM {table}),
 p AS (SELECT file, i, o, s, 0 AS chunk, 1 AS n, s AS total FROM r WHERE i = 1
 UNION ALL SELECT r.file, r.i, r.o, r.s, CASE WHEN p.n = {items} OR p.total + r.s > {most} THEN p.chunk + 1 ELSE p.chunk END, CASE WHEN p.n = {items} OR p.total + r.s > {most} THEN 1 ELSE p.n + 1 END, CASE WHEN p.n = {items} OR p.total + r.s > {most} THEN r.s ELSE p.total + r.s END
 FROM p JOIN r ON r.file = p.file AND r.i = p.i + 1)
 SELECT file, chunk, min(o) AS first, count(*) AS n, sum(s)::BIGINT AS size FROM p GROUP BY ALL"""


@query("win05_bounded_chunks", PACKED.format(key="o_custkey", order="o_orderkey", size="CAST(floor(o_totalprice) AS BIGINT)", table="orders", items=4, most=700000))
def win05_bounded_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), "o_orderkey", F.floor("o_totalprice").alias("s"))
    return P.bounded_chunks(rows, "file", "o_orderkey", "s", 4, 700000, 1 << 40)


@query("win05_chunks_by_sql", PACKED.format(key="o_custkey", order="o_orderkey", size="CAST(floor(o_totalprice) AS BIGINT)", table="orders", items=4, most=700000))
def win05_chunks_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chunks by the table function, from a SQL text."""
    P.register_chunks(spark, "tidemark_chunks")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("position"), F.floor("o_totalprice").alias("size"))
    return spark.sql("SELECT * FROM tidemark_chunks(max_items => 4, max_size => 700000, rows => TABLE({rows}) PARTITION BY file ORDER BY position)", rows=rows)


@query("win06_token_windows", PACKED.format(key="conv_id", order="turn", size="CAST(length(text) AS BIGINT)", table="conversations", items=1000, most=1500))
def win06_token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), "turn", F.length("text").alias("s"))
    return P.bounded_chunks(rows, "file", "turn", "s", 1000, 1500, 1 << 30)


@query("win07_stable_distinct", "SELECT conv_id, string_agg(role, ',' ORDER BY f) AS roles FROM (SELECT conv_id, role, min(turn) AS f FROM conversations GROUP BY ALL) GROUP BY conv_id")
def win07_stable_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("r"))
    return rows.select("conv_id", F.array_join(F.array_distinct("r"), ",").alias("roles"))


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    files = orders.select(F.col("o_orderkey").alias("file"), F.floor("o_totalprice").alias("bytes"), (F.col("o_orderkey") % 5 + 1).alias("rows"))
    line = table(spark, sf_dir, "lineitem")
    return files, line.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("file")), line.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("row_count")).select(F.col("l_orderkey").alias("file"), "row_count")


@query("agg18_progress", """WITH f AS (SELECT o_orderkey AS file, CAST(floor(o_totalprice) AS BIGINT) AS b, o_orderkey % 5 + 1 AS r FROM orders), g AS (SELECT DISTINCT l_orderkey AS file FROM lineitem WHERE l_returnflag = 'R'),
 c AS (SELECT l_orderkey AS file, count(DISTINCT l_suppkey) AS k, count(*) AS n FROM lineitem GROUP BY 1)
 SELECT count(*) AS files, count(g.file) AS acquired, sum(b)::BIGINT AS bytes, sum(CASE WHEN g.file IS NOT NULL THEN b END)::BIGINT AS acquired_bytes, sum(k)::BIGINT AS chunks, sum(n)::BIGINT AS rows_done, sum(r)::BIGINT AS rows, round(100.0 * sum(n) / sum(r), 2) AS percent
 FROM f LEFT JOIN g USING (file) LEFT JOIN c USING (file)""")
def agg18_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.progress(*_files(spark, sf_dir))


@query("agg19_file_completeness", "SELECT o_orderkey AS file, coalesce((SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) = o_orderkey % 5 + 1, false) AS complete FROM orders")
def agg19_file_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, _, chunks = _files(spark, sf_dir)
    return K.file_completeness(files, chunks)


@query("jn18_acquired_files", "SELECT o_orderpriority AS kind, count(*) AS files, count(g.l_orderkey) AS acquired FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') g ON l_orderkey = o_orderkey GROUP BY 1")
def jn18_acquired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("g")).distinct()
    orders = table(spark, sf_dir, "orders")
    return orders.join(got, orders["o_orderkey"] == got["g"], "left").groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("files"), F.count("g").alias("acquired"))


@query("jn19_source_bytes", "SELECT o_orderstatus AS status, count(*) AS sources, sum(CAST(floor(o_totalprice) AS BIGINT))::BIGINT AS bytes FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1")
def jn19_source_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    seen = orders.join(line, orders["o_orderkey"] == line["l_orderkey"], "left_semi")  # each source once, however many rows it has
    return seen.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("sources"), F.sum(F.floor("o_totalprice")).alias("bytes"))


@query("jn07_files_and_chunks", "SELECT o_orderkey, count(l_orderkey) AS chunks, coalesce(sum(l_quantity), 0) AS quantity FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = o_orderkey % 7 + 1 GROUP BY 1")
def jn07_files_and_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rows = orders.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    found = rows.join(line, (rows["o_orderkey"] == line["l_orderkey"]) & (line["l_linenumber"] == rows["o_orderkey"] % 7 + 1), "left")
    return found.groupBy("o_orderkey").agg(F.count("l_orderkey").alias("chunks"), F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"))


@query("agg17_queue_status", "SELECT count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders")
def agg17_queue_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.status_counts(table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"), ["O", "F", "P"])


@query("agg30_partition_report", "SELECT o_orderstatus AS status, count(*) AS n, sum(o_custkey)::BIGINT AS records FROM orders GROUP BY 1")
def agg30_partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.partition_report(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("record_count")))


@query("agg28_latest_completion", "SELECT CAST(ts AS DATE) AS day, max(ts) AS completed_at FROM events WHERE event_type = 'purchase' GROUP BY 1")
def agg28_latest_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy(F.col("ts").cast("date").alias("day")).agg(F.max("ts").alias("completed_at"))


@query("top07_refresh_queue", """WITH d AS (SELECT CAST(range AS DATE) AS day FROM range(DATE '2023-11-01', DATE '2024-02-11', INTERVAL 1 DAY)), c AS (SELECT CAST(ts AS DATE) + 0 - 40 AS day, max(ts) AS completed_at FROM events WHERE event_type = 'signup' AND event_id % 3 = 0 GROUP BY 1),
 q AS (SELECT day, completed_at, CASE WHEN day >= DATE '2024-02-10' - 29 THEN 'recent' ELSE 'rotating' END AS queue FROM d LEFT JOIN c USING (day))
 SELECT day, queue, CASE WHEN queue = 'recent' THEN row_number() OVER (PARTITION BY queue ORDER BY abs(DATE '2024-02-10' - day), day) ELSE row_number() OVER (PARTITION BY queue ORDER BY completed_at IS NOT NULL, completed_at NULLS FIRST, day) END AS position FROM q""")
def top07_refresh_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "events").where("event_type = 'signup' AND event_id % 3 = 0").groupBy(F.date_sub(F.col("ts").cast("date"), 40).alias("day")).agg(F.max("ts").alias("completed_at"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(2023, 11, 1)), F.lit(dt.date(2024, 2, 10)))).alias("day"))
    return K.refresh_queue(days.join(done, "day", "left"), dt.date(2024, 2, 10)).withColumn("position", F.col("position").cast("bigint"))


@query("agg20_measure_by_path", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS path, min(value) AS least, max(value) AS greatest, count(*) AS n FROM events GROUP BY 1")
def agg20_measure_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.payload import path

    return K.measure_by_path(table(spark, sf_dir, "events"), path(F.col("props"), "$.k", "bigint") % 10, F.col("value"))


def _taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = region.select(F.lit("region").alias("kind"), F.concat(F.lit("regions/"), F.col("r_regionkey") + F.when(F.col("r_regionkey") == 0, 1).otherwise(F.col("r_regionkey") * 0)).alias("id"), F.when(F.col("r_regionkey") != 3, F.col("r_name")).alias("display_name"))
    return rows.unionByName(nation.select(F.lit("nation").alias("kind"), F.concat(F.lit("nations/"), F.when(F.col("n_nationkey") % 10 == 4, "x").otherwise(F.col("n_nationkey").cast("string"))).alias("id"), F.col("n_name").alias("display_name")))


@query("flt15_identity_defects", """WITH r AS (SELECT 'region' AS kind, 'regions/' || greatest(r_regionkey, 1) AS id, CASE WHEN r_regionkey <> 3 THEN r_name END AS display_name FROM region
 UNION ALL SELECT 'nation', 'nations/' || CASE WHEN n_nationkey % 10 = 4 THEN 'x' ELSE n_nationkey::VARCHAR END, n_name FROM nation), s AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM r)
 SELECT id, kind, 'malformed_id' AS defect FROM s WHERE NOT regexp_full_match(id, kind || 's/[1-9][0-9]*') UNION ALL SELECT id, kind, 'duplicate_id' FROM s WHERE n > 1 UNION ALL SELECT id, kind, 'missing_name' FROM s WHERE display_name IS NULL""")
def flt15_identity_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.identity_defects(_taxonomy(spark, sf_dir), {"region": "regions/[1-9][0-9]*", "nation": "nations/[1-9][0-9]*"})


@query("jn15_unresolved_parents", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)")
def jn15_unresolved_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.unresolved_parents(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "nation").where("n_regionkey <> 2"), "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey")


@query("jn15_inconsistent_ancestry", "SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 IS DISTINCT FROM n_regionkey")
def jn15_inconsistent_ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", (F.col("c_custkey") % 5).cast("int").alias("n_regionkey"))
    return K.inconsistent_ancestry(child, table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_regionkey").select("c_custkey")


@query("src02_row_range", "SELECT l_orderkey, l_linenumber, rn AS row_number FROM (SELECT l_orderkey, l_linenumber, row_number() OVER () - 1 AS rn FROM lineitem) WHERE rn BETWEEN 1000 AND 1999")
def src02_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footer names the row groups that overlap; a task reads each of these and no other is opened."""
    return row_groups.row_range(spark, f"{sf_dir}/lineitem.parquet", 1000, 2000, ["l_orderkey", "l_linenumber"])


@query("src16_point_lookup", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey = 77")
def src16_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.point_lookup(spark, [f"{sf_dir}/lineitem.parquet"], "l_orderkey", 77).select("l_orderkey", "l_linenumber", "l_partkey")


@query("src16_indexed_lookup", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey = 77")
def src16_indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines lie in fifty files by hash, so ranges tell nothing; the index's filters pick the one or two to open."""
    at, index = work_dir(spark, "files"), work_dir(spark, "index")
    table(spark, sf_dir, "lineitem").repartition(50, "l_orderkey").write.parquet(at)
    file_index.build(spark, [at], "l_orderkey", index)
    if len(file_index.candidates(spark, index, 77)) > 2:
        raise ValueError("the index opens more than two files")
    return file_index.lookup(spark, index, [at], "l_orderkey", 77).select("l_orderkey", "l_linenumber", "l_partkey")


@query("src01_size_guard", "SELECT sum(strlen(t))::BIGINT AS total, max(strlen(t))::INTEGER AS greatest, sum(strlen(t)) <= 16777216 AND max(strlen(t)) <= 1048576 AS ok FROM (SELECT '{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderpriority\":\"' || o_orderpriority || '\"}' AS t FROM orders)")
def src01_size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.size_guard(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"))


@query("src06_page_defects", """SELECT user_id AS scan_id, unnest(list_filter([CASE WHEN count(DISTINCT event_id % 2) > 1 THEN 'unstable_count' END, CASE WHEN count(event_id % 500) > count(DISTINCT event_id % 500) THEN 'repeated_cursor' END,
 CASE WHEN bool_or(event_id % 9 = 0 AND event_type <> 'error') THEN 'empty_page' END], lambda x: x IS NOT NULL)) AS defect FROM events GROUP BY user_id""")
def src06_page_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("scan_id"), (F.col("event_id") % 2).alias("total"), (F.col("event_id") % 500).alias("cursor"), (F.col("event_id") % 9).alias("n"), (F.col("event_type") == "error").alias("last"))
    return S.page_defects(rows)


@query("snk05_upsert", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, 0 AS f FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 3 = 0) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, f DESC) = 1""")
def snk05_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("v", F.struct("o_orderdate", "o_orderkey"))
    return sinks.merged(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0"), ["o_custkey"], "v").select("o_custkey", "o_orderkey", "o_totalprice")


@query("snk03_raw_receipts", "SELECT conv_id, turn, sha256(text) AS sha256, strlen(text)::INTEGER AS size FROM conversations")
def snk03_raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.raw_receipts(table(spark, sf_dir, "conversations").withColumnRenamed("text", "body")).select("conv_id", "turn", "sha256", "size")
