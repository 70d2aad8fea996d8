"""Further queries: lists of a scope, coverage measures, payload predicates, clean-up functions, queues, set steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import payload as P
from tidemark.functions import text as T
from tidemark.operators import attention as A
from tidemark.operators import catalog as K
from tidemark.operators import corpus as C
from tidemark.operators import emergence as E
from tidemark.operators import topics as L
from tidemark.operators import versions as V
from tidemark.plans import attention as cells
from tidemark.plans import emergence as topics
from tidemark.plans.registry import query, table
from tidemark.sources import files as S
from tidemark.sources.durable import work_dir

LISTS = C.Scope(dt.date(1990, 1, 1), dt.date(2030, 1, 1), domains=("1", "2"), not_fields=("3", "4"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, (F.col("p_size") % 4).cast("string")).alias("domain"), F.when(F.col("p_size") % 6 != 0, (F.col("p_size") % 6).cast("string")).alias("field"))


@query("flt02_include_lists", "SELECT p_partkey FROM part WHERE p_size % 4 IN (1, 2)")
def flt02_include_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).where(LISTS.allowed(F.col("domain"), LISTS.domains)).select("p_partkey")


@query("flt03_exclude_lists", "SELECT p_partkey FROM part WHERE p_size % 6 NOT IN (3, 4)")
def flt03_exclude_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).where(~LISTS.denied(F.col("field"), LISTS.not_fields)).select("p_partkey")


@query("flt06_has_abstract", "SELECT p_partkey FROM part WHERE p_size % 5 NOT IN (0, 1, 2, 3)")
def flt06_has_abstract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(F.lit(None).cast("string"), F.lit("{}"), F.lit('"null"'), F.lit('""'), F.lit('{"a":[0]}')), F.col("p_size") % 5 + 1)
    value = F.try_parse_json(raw)
    kind = F.schema_of_variant(value)
    filled = F.startswith(kind, F.lit("OBJECT<")) & (kind != "OBJECT<>") | (kind == "STRING") & ~F.try_variant_get(value, "$", "string").isin("", "{}", "null", '""')
    return table(spark, sf_dir, "part").where(F.coalesce(filled, F.lit(False))).select("p_partkey")


@query("flt07_residual_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND l_suppkey % 3 = 1")
def flt07_residual_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = C.Scope(dt.date(1997, 1, 1), dt.date(1997, 12, 31), domains=("1",))
    line = table(spark, sf_dir, "lineitem")
    pushed = line.where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    day = F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd")
    judged = scope.disposition(day, F.lit(False), F.lit("w"), (F.col("l_suppkey") % 3).cast("string"), F.lit(None).cast("string"))
    return pushed.where(judged == "selected").select("l_orderkey", "l_linenumber")


@query("flt16_scoped_views", "SELECT c_mktsegment AS scope, count(*) AS orders FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1")
def flt16_scoped_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoped = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("scope"))
    return table(spark, sf_dir, "orders").join(scoped, "o_custkey").groupBy("scope").agg(F.count("*").alias("orders"))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.attention_cube(spark, sf_dir)


CUBE = f"""{cells.ROLES} SELECT topic_id, platform, month, CASE WHEN known > 0 THEN greatest(coalesce(mentions, 0), truncated_total)::BIGINT END AS estimated, total FROM covered LEFT JOIN counted USING (topic_id, platform, channel, month) LEFT JOIN volumes USING (platform, channel, month)"""


@query("agg09_estimates", f"SELECT topic_id, platform, month, estimated FROM ({CUBE})")
def agg09_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cube(spark, sf_dir).select("topic_id", "platform", "month", "estimated")


@query("agg10_shares", f"SELECT topic_id, platform, count(estimated::DOUBLE / nullif(total, 0)) AS known, round(sum(estimated::DOUBLE / nullif(total, 0)), 4) AS total_share FROM ({CUBE}) GROUP BY ALL")
def agg10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = cells.roles(spark, sf_dir)
    out = A.cube(r["links"], cells._counted(r), A.coverage(r["links"], r["cells"], r["spine"]), r["volumes"])
    return out.groupBy("topic_id", "platform").agg(F.count("share").alias("known"), F.round(F.sum("share"), 4).alias("total_share"))


@query("jn11_dense_grid", f"{cells.ROLES} SELECT platform, count(*) AS cells, count(total) AS with_volume, count(mentions) AS with_mentions FROM covered LEFT JOIN counted USING (topic_id, platform, channel, month) LEFT JOIN volumes USING (platform, channel, month) GROUP BY 1")
def jn11_dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cube(spark, sf_dir)
    return out.groupBy("platform").agg(F.count("*").alias("cells"), F.count("volume").alias("with_volume"), F.count(F.when(F.col("mentions") > 0, 1)).alias("with_mentions"))


@query("agg13_mean_share", f"{topics.ROLES} SELECT topic, round(mean_share, 6) AS mean_share FROM growth")
def agg13_mean_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.annual_growth(E.yearly_series(*topics.roles(spark, sf_dir), topics.FIRST, topics.LAST))
    return out.select("topic", F.round("mean_share", 6).alias("mean_share"))


@query("win08_quadrant_counts", f"{topics.ROLES}, q AS (SELECT {topics.QUADRANT} AS emergence_quadrant FROM growth, cut) SELECT emergence_quadrant, count(*) AS n FROM q GROUP BY 1")
def win08_quadrant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.emergence_quadrants(spark, sf_dir).groupBy("emergence_quadrant").agg(F.count("*").alias("n"))


@query("top08_claim_oldest", "SELECT o_orderstatus AS worker, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) = 1")
def top08_claim_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return rows.groupBy(F.col("o_orderstatus").alias("worker")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("set03_distinct", "SELECT DISTINCT event_type, user_id % 10 AS channel FROM events")
def set03_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 10).alias("channel")).distinct()


@query("set04_work_list", """WITH s AS (SELECT o_orderkey AS id, date_trunc('month', o_orderdate)::DATE AS ws, CAST(o_custkey % 3 + 1 AS INTEGER) AS n FROM orders)
 SELECT id, ws AS window_start, (ws + to_months(n))::DATE AS window_end FROM s WHERE n < 2 UNION ALL SELECT id, ws, (ws + to_months(n // 2))::DATE FROM s WHERE n >= 2 UNION ALL SELECT id, (ws + to_months(n // 2))::DATE, (ws + to_months(n))::DATE FROM s WHERE n >= 2""")
def set04_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, span = F.trunc(F.col("o_orderdate").cast("date"), "MM"), (F.col("o_custkey") % 3 + 1).cast("int")
    scans = table(spark, sf_dir, "orders").select(F.lit("p").alias("platform"), F.lit("c").alias("channel"), F.col("o_orderkey").cast("string").alias("term_id"), F.col("o_orderkey").alias("scan_id"), start.alias("window_start"), F.add_months(start, span).alias("window_end"), F.when(span > 1, "split").otherwise("pending").alias("status"))
    kids = A.split_children(scans).select(F.col("parent_id").alias("id"), "window_start", "window_end")
    return scans.where("status <> 'split'").select(F.col("scan_id").alias("id"), "window_start", "window_end").unionByName(kids)


@query("str05_strip_nul", "SELECT conv_id, turn, text || 'x' AS t FROM conversations")
def str05_strip_nul(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.strip_nul(F.concat("text", F.lit("\0x\0"))).alias("t"))


@query("str07_phrase_text", "SELECT p_partkey, trim(regexp_replace(replace('\"' || p_name || '\"  ' || p_type, '\"', ' '), '\\s+', ' ', 'g')) AS t FROM part")
def str07_phrase_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.phrase_text(F.concat(F.lit('"'), "p_name", F.lit('"  '), "p_type")).alias("t"))


@query("dt04_months_touched", "SELECT o_orderkey, datediff('month', o_orderdate, o_orderdate + to_days(CAST(o_custkey % 100 AS INTEGER))) + 1 AS months FROM orders")
def dt04_months_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(D.months_touched(day, F.date_add(day, (F.col("o_custkey") % 100).cast("int")))).cast("bigint").alias("months"))


@query("dt07_instants", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS instant FROM orders")
def dt07_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.element_at(F.array(F.concat(stamp, F.lit("+02:00")), F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(stamp, F.lit("Z")), F.lit("at noon")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", D.utc_instant(raw).cast("string").alias("instant"))


@query("dt09_recent_days", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS today, (unnest(range(CAST(o_orderdate AS DATE) - 30, CAST(o_orderdate AS DATE), INTERVAL 1 DAY)))::DATE AS day FROM orders")
def dt09_recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("today")).distinct()
    return days.select("today", F.explode(D.recent_days(F.col("today"))).alias("day"))


@query("math02_rounded_sizes", "SELECT o_orderkey, (c // 1024 + CASE WHEN c % 1024 > 512 OR (c % 1024 = 512 AND (c // 1024) % 2 = 1) THEN 1 ELSE 0 END) / 100.0::DOUBLE AS kib FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)")
def math02_rounded_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two places, half to even, of the exact decimal."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.bround(F.round("o_totalprice", 2).cast("decimal(15,2)") / 1024, 2).cast("double").alias("kib"))


@query("math04_budgets", """WITH q AS (SELECT o_orderkey, CAST(o_orderkey % 20 AS BIGINT) AS c, CAST(o_custkey % 9 AS BIGINT) AS a, CAST(o_custkey % 17 AS BIGINT) AS b FROM orders), s AS (SELECT *, CAST((6 * c + 5) // 10 AS BIGINT) AS r FROM q), f AS (SELECT *, least(r, a) AS x, least(c - r, b) AS y FROM s), g AS (SELECT *, x + least(c - x - y, a - x) AS recent FROM f)
 SELECT o_orderkey, recent, y + least(c - recent - y, b - y) AS rotating FROM g""")
def math04_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = K.budget(F.col("o_orderkey") % 20, 0.6, F.col("o_custkey") % 9, F.col("o_custkey") % 17)
    return table(spark, sf_dir, "orders").select("o_orderkey", split.alias("s")).select("o_orderkey", "s.*")


@query("arr03_distinct_slice", "SELECT conv_id, array_to_string(list_slice(list(role ORDER BY f), 1, 2), ',') AS roles FROM (SELECT conv_id, role, min(turn) AS f FROM conversations GROUP BY ALL) GROUP BY conv_id")
def arr03_distinct_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("r"))
    return lists.select("conv_id", F.array_join(F.slice(F.array_distinct("r"), 1, 2), ",").alias("roles"))


@query("json02_array_functions", "SELECT conv_id, count(*) AS n, min(length(text))::INTEGER AS shortest FROM conversations GROUP BY conv_id")
def json02_array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.collect_list(F.struct("turn", "text"))).alias("j"))
    sizes = F.transform(F.from_json("j", "array<struct<turn:bigint,text:string>>"), lambda x: F.length(x["text"]))
    return packed.select("conv_id", F.json_array_length("j").cast("bigint").alias("n"), F.array_min(sizes).alias("shortest"))


@query("json05_identities", "SELECT n_regionkey, sha256('taxonomy-v1' || chr(10) || '[' || string_agg('{\"id\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}', ',' ORDER BY n_nationkey) || ']') AS h FROM nation GROUP BY 1")
def json05_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))))).alias("j"))
    return lists.select("n_regionkey", F.sha2(F.concat(F.lit("taxonomy-v1\n"), P.canonical(F.col("j"))), 256).alias("h"))


@query("json06_request_hash", """SELECT o_orderkey, sha256('{"limit": ' || o_orderkey % 10 || ', "topics": ["' || o_orderpriority || '", "' || o_orderstatus || '"]}') AS h FROM orders""")
def json06_request_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = F.create_map(F.lit("topics"), P.spaced_list(F.array("o_orderpriority", "o_orderstatus")), F.lit("limit"), (F.col("o_orderkey") % 10).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.sha2(P.spaced_object(request), 256).alias("h"))


@query("src03_inventory", "SELECT 'updated_date=' || strftime(d, '%Y-%m-%d') || '/part-' || k AS url, b AS bytes, n AS rows, d AS updated_date FROM (SELECT o_orderpriority[1] AS k, date_trunc('year', o_orderdate)::DATE AS d, sum(o_custkey)::BIGINT AS b, count(*) AS n FROM orders GROUP BY ALL)")
def src03_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("k"), F.trunc(F.col("o_orderdate").cast("date"), "year").alias("d")).agg(F.sum("o_custkey").alias("bytes"), F.count("*").alias("rows"))
    rows = rows.select(F.concat(F.lit("updated_date="), F.date_format("d", "yyyy-MM-dd"), F.lit("/part-"), "k").alias("url"), "bytes", "rows")
    return S.inventory(rows.agg(F.collect_list(F.struct("url", "bytes", "rows")).alias("entries"), F.sum("bytes").alias("total_bytes"), F.sum("rows").alias("total_rows")))


@query("src08_page_items", "SELECT CAST(conv_id AS BIGINT) AS page, CAST(turn AS BIGINT) AS turn, role FROM conversations")
def src08_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("page")).agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role")).alias("hits"))).alias("body"))
    return S.pages(bodies, "hits", "turn:bigint,role:string")


@query("snk04_insert_or_ignore", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0")
def snk04_insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return V.unprocessed(rows.dropDuplicates(["c_custkey"]), rows.where("c_custkey % 3 = 0"), ["c_custkey"])


@query("stm04_late_baseline", "SELECT entity_id, arg_max(version_id, (t, version_id)) AS version_id FROM (SELECT o_custkey AS entity_id, o_orderkey AS version_id, o_orderdate AS t FROM orders) GROUP BY 1")
def stm04_late_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "orders").select(F.lit("s").alias("scope_id"), F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("version_id"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("updated_date"), F.lit(True).alias("is_api"), F.lit(0).alias("observed_at"))
    late = seen.withColumns({"is_api": F.lit(False), "updated_date": F.lit("1990-01-01"), "version_id": F.lit(-1).cast("bigint"), "observed_at": F.lit(9)}).distinct()
    return V.reconcile(seen.unionByName(late)).select("entity_id", "version_id")


@query("stm04_streamed_versions", """WITH o AS (SELECT o_custkey AS entity_id, o_orderkey AS version_id, CAST(o_orderdate AS DATE) AS t FROM orders)
 SELECT entity_id, arg_max(version_id, (t, version_id)) AS version_id, count(DISTINCT version_id) + 1 AS versions FROM o GROUP BY 1""")
def stm04_streamed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stream of observations, newest first, then an old baseline and all of them once more: state per customer settles as the batch does."""
    from tidemark.streaming import versions as stream

    at = work_dir(spark, "observations")
    seen = table(spark, sf_dir, "orders").select(F.lit("s").alias("scope_id"), F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("version_id"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("updated_date"), F.lit(True).alias("is_api"), F.lit(0).alias("observed_at"))
    late = seen.withColumns({"is_api": F.lit(False), "updated_date": F.lit("1990-01-01"), "version_id": F.lit(-1).cast("bigint"), "observed_at": F.lit(9)}).distinct()
    for k, part in enumerate((seen.where("updated_date >= '1995-01-01'"), seen.where("updated_date < '1995-01-01'"), late.unionByName(seen))):
        part.write.mode("append").parquet(f"{at}/in-{k}")
        own = spark.newSession()  # its state store is RocksDB, the caller's settings stay
        own.conf.set("spark.sql.streaming.stateStore.providerClass", stream.ROCKSDB)
        source = own.readStream.schema(seen.schema).option("maxFilesPerTrigger", 1000).parquet(f"{at}/in-*")
        write = lambda df, n: df.write.mode("append").parquet(f"{at}/out")
        stream.reconciled(source).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start().awaitTermination()
    rows = stream.last_rows(spark.read.parquet(f"{at}/out"))
    return rows.select("entity_id", "version_id", F.size("version_ids").cast("bigint").alias("versions"))


@query("stm05_reverted_versions", "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 2")
def stm05_reverted_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions A and B of every customer are processed. A again, or B, is not new; only the third that moves to C is."""
    version = lambda suffix: F.sha2(F.concat("c_name", F.lit(suffix)), 256).alias("content_hash")
    rows = table(spark, sf_dir, "customer")
    done = rows.select("c_custkey", version("A")).unionByName(rows.select("c_custkey", version("B")))
    now = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("c_custkey") % 3 + 1).cast("int"))
    return V.unprocessed(rows.select("c_custkey", F.sha2(F.concat("c_name", now), 256).alias("content_hash")), done, ["c_custkey", "content_hash"]).select("c_custkey")


@query("stm07_queue_cursor", "SELECT count(*) || ':' || min(o_orderkey) || ':' || max(o_orderkey) AS cursor FROM orders WHERE o_orderstatus = 'O'")
def stm07_queue_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    return waiting.agg(F.concat_ws(":", F.count("*").cast("string"), F.min("o_orderkey").cast("string"), F.max("o_orderkey").cast("string")).alias("cursor"))


@query("ml03_adopted_runs", "SELECT o_custkey AS request_hash, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS run_id FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def ml03_adopted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("request_hash"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"), F.col("o_orderdate").alias("finished_at"))
    return L.adopted(runs).select("request_hash", "run_id")
