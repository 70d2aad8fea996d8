"""Sinks that write and read back, file checks, scan requests, leases, summaries, vector tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import runs as R
from tidemark.operators import topics as T
from tidemark.operators import vectors as V
from tidemark.plans.registry import query, table
from tidemark.sources import files as S
from tidemark.sources import points, sinks, snapshots
from tidemark.sources.durable import work_dir


@query("src01_json_records", "SELECT p_partkey, strlen('{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\",\"p_brand\":\"' || p_brand || '\",\"p_size\":' || p_size || '}')::INTEGER AS size FROM part")
def src01_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.json_records(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    return rows.select(F.get_json_object("record", "$.p_partkey").cast("bigint").alias("p_partkey"), "size")


@query("src04_validate_files", "SELECT * FROM (VALUES ('nation.parquet', true, true), ('part.parquet', true, false), ('region.parquet', false, true), ('absent.parquet', false, false)) t(name, size_ok, checksum_ok)")
def src04_validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest is right for one file, and wrong for the others in checksum, in size, and in that there is no such file."""
    at = f"{sf_dir}/{{nation,part,region}}.parquet"
    files = spark.read.format("binaryFile").load(at).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    wrong = files.select("name", F.when(F.col("name") == "region.parquet", F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"), F.when(F.col("name") == "part.parquet", F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    absent = spark.range(1).select(F.lit("absent.parquet").alias("name"), F.lit(1).cast("bigint").alias("bytes"), F.lit("00").alias("sha256"))
    return S.validate_files(spark, at, wrong.unionByName(absent))


@query("src04_counted_files", "SELECT 'customer.parquet' AS name, true AS size_ok, true AS checksum_ok, (SELECT count(*) FROM customer) > 0 AS rows_ok UNION ALL SELECT 'supplier.parquet', true, true, (SELECT count(*) FROM supplier) < 0")
def src04_counted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 sums and row counts: right for one file; of the other one row more is asked for."""
    at = f"{sf_dir}/{{customer,supplier}}.parquet"
    files = spark.read.format("binaryFile").load(at).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    counts = {t: table(spark, sf_dir, t).count() for t in ("customer", "supplier")}
    rows = F.when(F.col("name") == "customer.parquet", counts["customer"]).otherwise(counts["supplier"] + 1)
    return S.validate_files(spark, at, files.withColumn("rows", rows))


@query("src15_cached_read", "SELECT o_custkey, count(*) AS n, sum(o_totalprice > 200000)::BIGINT AS large FROM orders GROUP BY 1")
def src15_cached_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first read finds no table and keeps what the fallback gives; the second, whose fallback gives no row, reads what is kept."""
    at = f"{work_dir(spark, 'cached')}/orders"
    orders = table(spark, sf_dir, "orders")
    S.read_or(spark, at, lambda: orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 200000).alias("large")))
    return S.read_or(spark, at, lambda: orders.limit(0))


@query("src05_acquired_files", """SELECT p_partkey::VARCHAR AS name, CASE WHEN p_partkey % 5 IN (0, 1, 4) THEN strlen(p_partkey::VARCHAR) + CASE WHEN p_partkey % 5 = 1 THEN 1 ELSE 0 END WHEN p_partkey % 5 = 2 THEN strlen(p_partkey::VARCHAR) END::BIGINT AS size, p_partkey % 5 = 0 AS adopted,
 CASE p_partkey % 5 WHEN 1 THEN 'size' WHEN 2 THEN 'checksum' WHEN 3 THEN 'unreachable' END AS defect FROM part""")
def src05_acquired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are files whose content is their name: a fifth has a receipt, others come long, wrong, not at all, or well."""
    name, kind = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    files = table(spark, sf_dir, "part").select(name.alias("name"), F.length(name).alias("bytes"), F.sha2(F.when(kind == 2, F.concat(name, F.lit("?"))).otherwise(name), 256).alias("sha256"), kind.alias("kind"))

    def fetch(name: str) -> bytes:
        if int(name) % 5 == 3:
            raise OSError("no answer")
        return (name + "+" * (int(name) % 5 == 1)).encode()

    return S.acquire(files.drop("kind"), files.where("kind = 0").select("name", "sha256"), fetch).drop("content")


@query("snk01_published_output", "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def snk01_published_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as derived Parquet under a name of their content, published twice, read back and counted."""
    orders, folder = table(spark, sf_dir, "orders"), work_dir(spark, "publish")
    at = sinks.publish(orders, folder)
    if sinks.publish(orders.repartition(3), folder) != at:
        raise ValueError("the same rows have two names")
    return spark.read.parquet(at).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("snk02_append_new", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS origin FROM customer")
def snk02_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = work_dir(spark, "append")
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    sinks.append_new(rows.where("c_custkey % 2 = 0").withColumn("origin", F.lit("first")), at, ["c_custkey"])
    sinks.append_new(rows.withColumn("origin", F.lit("second")), at, ["c_custkey"])
    return spark.read.parquet(at)


@query("snk07_enqueued_claims", "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS run FROM orders o WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def snk07_enqueued_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unprocessed orders are put in a queue table: a first run half of them, a second all, of which it appends what is not queued."""
    at = work_dir(spark, "queue")
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    claims = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey").join(done, "o_orderkey", "left_anti")
    sinks.append_new(claims.where("o_orderkey % 2 = 0").withColumn("run", F.lit(1)), at, ["o_orderkey"])
    sinks.append_new(claims.withColumn("run", F.lit(2)), at, ["o_orderkey"])
    return spark.read.parquet(at)


@query("snk06_rebuilt_slice", "SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_custkey ELSE o_custkey END AS v FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0")
def snk06_rebuilt_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All slices are written; then one is rebuilt from fewer rows, and the others stay."""
    at = work_dir(spark, "rebuild")
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", F.col("o_custkey").alias("v"))
    sinks.rebuild(rows, at, "o_orderstatus")
    sinks.rebuild(rows.where("o_orderstatus = 'F' and o_orderkey % 2 = 0").withColumn("v", -F.col("v")), at, "o_orderstatus")
    return spark.read.parquet(at).select("o_orderstatus", "o_orderkey", "v")


@query("snk10_committed_runs", "SELECT 'run-' || l AS run_id, count(DISTINCT o_orderpriority) AS topics, count(*) AS works FROM orders, (VALUES (1), (3)) t(l) GROUP BY 1")
def snk10_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs persist topics and works together; the second breaks off before its manifest, the third after it and is tried again."""
    at = work_dir(spark, "runs")
    topics = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("topic")).agg(F.count("*").alias("size"))
    works = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id"), F.col("o_orderpriority").alias("topic"))

    def broken(stage: str):
        def fail(now: str) -> None:
            if now == stage:
                raise OSError(stage)

        return fail

    for k, stage in ((1, ""), (2, "written"), (3, "committed"), (3, "")):
        try:
            snapshots.commit({"topics": topics, "works": works}, at, f"run-{k}", broken(stage))
        except OSError:
            continue
    counts = [snapshots.read(spark, at, t).groupBy("run_id").agg(F.count("*").alias(t)) for t in ("topics", "works")]
    return counts[0].join(counts[1], "run_id")


@query("snk11_replaced_labels", "SELECT o_custkey AS topic, max(o_orderkey) AS headline FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def snk11_replaced_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label is replaced by a later one of its topic; topics without a new label keep theirs."""
    labels = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("topic"), F.col("o_orderkey").alias("headline"), "o_orderstatus")
    first = labels.where("o_orderstatus = 'F'").groupBy("topic").agg(F.max("headline").alias("headline"))
    later = labels.where("o_orderstatus = 'O'").groupBy("topic").agg(F.max("headline").alias("headline"))
    return sinks.merged(first, later, ["topic"], "headline")


@query("snk12_insert_once", "SELECT o_custkey AS run_id, CASE WHEN max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END) IS NOT NULL THEN max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END) ELSE min(o_orderkey) END AS row_value FROM orders GROUP BY 1")
def snk12_insert_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("row_value"))
    have = rows.where("row_value % 3 = 0").groupBy("run_id").agg(F.max("row_value").alias("row_value"))
    return R.insert_once(have, rows, ["run_id"])


@query("snk08_vector_upserts", "SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 2 ELSE 1 END AS version, round(embedding[1]::DOUBLE * CASE WHEN vec_id % 4 = 0 THEN 2 ELSE 1 END, 6) AS x FROM embeddings")
def snk08_vector_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 256 points are staged by tasks and published together; a later write of a point replaces it for readers."""
    at = work_dir(spark, "points")
    spark.dataSource.register(points.point_sink("tidemark_points", points.FolderStore(at)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.lit(1).alias("version"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    later = rows.where("vec_id % 4 = 0").select("vec_id", F.lit(2).alias("version"), F.transform("vector", lambda x: x * 2).alias("vector"))
    for df in (rows, later):
        df.write.format("tidemark_points").mode("append").save()
    both = points.published(spark, at)
    return sinks.merged(both.limit(0), both, ["vec_id"], "version").select("vec_id", "version", F.round(F.element_at("vector", 1), 6).alias("x"))


@query("src13_vectors_by_payload", "SELECT label, count(*) AS n, min(vec_id) AS first FROM embeddings WHERE vec_id % 365 BETWEEN 100 AND 200 GROUP BY 1")
def src13_vectors_by_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("vec_id") % 365).cast("int"))
    points = table(spark, sf_dir, "embeddings").withColumn("published", day)
    found = V.matching(points, dt.date(2024, 1, 1) + dt.timedelta(100), dt.date(2024, 1, 1) + dt.timedelta(200))
    return found.groupBy("label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))


@query("stm09_freeze_or_resume", """WITH s AS (SELECT o_custkey % 50 AS k, min(o_orderkey) AS open FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
 SELECT c_custkey AS request_id, CASE WHEN c_custkey % 5 = 0 AND o_orderkey IS NOT NULL THEN c_custkey ELSE coalesce(open, c_custkey) END AS scan_id, CASE WHEN c_custkey % 5 = 0 AND o_orderkey IS NOT NULL OR open IS NOT NULL THEN 'resume' ELSE 'new' END AS action
 FROM customer LEFT JOIN s ON k = c_custkey % 60 LEFT JOIN orders ON o_orderkey = c_custkey""")
def stm09_freeze_or_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are scans of fifty keys; customers ask for one of sixty keys, each fifth for a scan by its name."""
    scans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scan_id"), (F.col("o_custkey") % 50).alias("request_key"), F.lit("source").alias("source"), F.when(F.col("o_orderstatus") == "F", "complete").otherwise("running").alias("status"))
    named = scans.select(F.col("scan_id").alias("c_custkey"), F.lit(True).alias("there"))
    asked = table(spark, sf_dir, "customer").join(named, "c_custkey", "left")
    by_name = F.when((F.col("c_custkey") % 5 == 0) & F.col("there"), F.col("c_custkey"))
    return R.freeze_or_resume(asked.select(F.col("c_custkey").alias("request_id"), (F.col("c_custkey") % 60).alias("request_key"), F.lit("source").alias("source"), by_name.alias("scan_id")), scans)


NOW, RETRY = dt.datetime(1996, 1, 1), dt.datetime(1995, 1, 1)
LEASED = """WITH q AS (SELECT o_orderkey AS id, o_orderpriority AS platform, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'claimed' END AS status, CAST(o_custkey % 4 AS INTEGER) AS attempts, o_orderdate AS t FROM orders),
 f AS (SELECT platform, min(id) AS first FROM q WHERE status = 'pending' OR (status = 'claimed' AND t < TIMESTAMP '1996-01-01') OR (status = 'failed' AND attempts < 3 AND t < TIMESTAMP '1995-01-01') GROUP BY 1)"""


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "failed").otherwise("claimed")
    time = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("platform"), status.alias("status"), (F.col("o_custkey") % 4).cast("int").alias("attempts"), F.lit(0).alias("fence"), time.alias("claimed_until"), time.alias("updated_at"))


@query("stm03_leases", f"{LEASED} SELECT id, CASE WHEN id = first THEN 'claimed' ELSE status END AS status, attempts + CASE WHEN id = first THEN 1 ELSE 0 END AS attempts, CASE WHEN id = first THEN 1 ELSE 0 END AS fence FROM q LEFT JOIN f USING (platform)")
def stm03_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each platform's worker leases its oldest runnable row: pending, expired, or failed with attempts left."""
    return R.claim(_queue(spark, sf_dir), "platform", NOW, 600, RETRY, 3).select("id", "status", "attempts", "fence")


@query("stm03_settled", f"{LEASED} SELECT id, CASE WHEN id = first AND id % 3 = 0 THEN 'complete' WHEN id = first AND id % 3 = 1 THEN 'pending' WHEN id = first THEN 'claimed' ELSE status END AS status, attempts + CASE WHEN id = first AND id % 3 <> 1 THEN 1 ELSE 0 END AS attempts FROM q LEFT JOIN f USING (platform)")
def stm03_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the leases: done, released, or of a worker whose fence is out of date; rows that nobody leased stay."""
    held = R.claim(_queue(spark, sf_dir), "platform", NOW, 600, RETRY, 3)
    outcome = F.when(F.col("id") % 3 == 1, "released").otherwise("complete")
    results = held.where("fence = 1").select("id", (F.col("fence") - F.when(F.col("id") % 3 == 2, 1).otherwise(0)).alias("fence"), outcome.alias("outcome"))
    return R.settle(held, results, NOW).select("id", "status", "attempts")


@query("stm10_drained_queues", """WITH p AS (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'recent' ELSE 'rotating' END AS queue, row_number() OVER (PARTITION BY event_type IN ('click', 'view') ORDER BY event_id) AS position FROM events)
 SELECT event_id, queue FROM p WHERE position <= CASE queue WHEN 'recent' THEN 12 ELSE 8 END""")
def stm10_drained_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window as W

    from tidemark.operators import catalog as K

    queue = F.when(F.col("event_type").isin("click", "view"), "recent").otherwise("rotating")
    rows = table(spark, sf_dir, "events").select("event_id", queue.alias("queue"))
    placed = rows.withColumn("position", F.row_number().over(W.partitionBy("queue").orderBy("event_id"))).where("position <= 20")
    units = K.budget(F.lit(20).cast("bigint"), 0.6, F.lit(1000).cast("bigint"), F.lit(1000).cast("bigint"))
    return R.drain(placed, units["recent"], units["rotating"]).select("event_id", "queue")


@query("math03_backoff", "SELECT l_orderkey, l_linenumber, least(2.0 * pow(2.0, l_linenumber - 1), 60.0) * (0.5 + (l_partkey % 10) / 10.0 / 2) AS seconds FROM lineitem")
def math03_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", R.backoff(F.col("l_linenumber"), 2.0, 60.0, F.col("l_partkey") % 10 / 10.0).alias("seconds"))


@query("llm01_summaries", "SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'known' ELSE regexp_replace(substr(role || ': ' || text, 1, 20), '\\s+$', '') END AS summary FROM conversations")
def llm01_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns are works of a conversation; the first of each is cached, the port summarises the others."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("topic"), F.col("turn").alias("work_id"), F.col("role").alias("title"), F.col("text").alias("abstract"))
    cached = turns.where("work_id = 0").select("topic", "work_id", F.lit("known").alias("summary"))
    out = T.summaries(turns, cached, lambda prompt: prompt[:20], "{title}: {abstract}")
    return out.select(F.col("topic").alias("conv_id"), F.col("work_id").alias("turn"), "summary")


@query("llm01_headlines", """WITH s AS (SELECT conv_id, count(*) AS n, sum(2) AS tokens FROM conversations GROUP BY 1)
 SELECT conv_id, CASE WHEN tokens <= 6 THEN 1 ELSE (n + 2) // 3 END::INTEGER AS chunk_count, 'succeeded' AS status FROM s""")
def llm01_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of two words each: up to three fit a window, more are headed window by window and then together."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("topic"), F.col("turn").alias("position"), F.concat_ws(" ", "role", F.lit("said")).alias("summary"))
    out = T.headlines(rows, lambda prompt: f"head of {len(prompt.split())}", lambda text: len(text.split()), "{summaries}", 6)
    return out.select(F.col("topic").alias("conv_id"), "chunk_count", "status")


@query("llm03_token_counts", "SELECT conv_id, turn, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))::BIGINT AS tokens FROM conversations")
def llm03_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The port here counts words; topics.tokenizer_file makes one of a tokenizer's file."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.token_counts(F.col("text"), lambda text: len(text.split())).alias("tokens"))
