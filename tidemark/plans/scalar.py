"""Scalar functions over documents, events, orders, parts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import payload as P
from tidemark.functions import text as T
from tidemark.plans.registry import query, table

NORMAL = "trim(replace(regexp_replace(lower(text), '[^\\pL\\pN_]+', ' ', 'g'), '_', ' '))"


@query("str01_normalize", f"SELECT doc_id, md5({NORMAL}) AS h FROM documents")
def str01_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalize(F.col("text"))).alias("h"))


@query("flt11_phrase_match", f"SELECT doc_id FROM documents WHERE contains(' ' || {NORMAL} || ' ', ' of the ')")
def flt11_phrase_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(T.contains_phrase(F.col("text"), F.lit("of the"))).select("doc_id")


@query("str02_plain_markup", """SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))) AS h FROM pages""")
def str02_plain_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.plain(F.col("html"))).alias("h"))


@query("str02_plain_all_references")
def str02_plain_all_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.plain_udf(F.col("html"))).alias("h"))


@query("str03_identities", "SELECT doc_id, sha256('term-v1' || chr(10) || lang) AS term_id, sha256(coalesce(source, '') || chr(10) || substr(text, 1, 200)) AS content_hash FROM documents")
def str03_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.term_id(F.col("lang")).alias("term_id"), T.content_hash(F.col("source"), F.col("text"), 200).alias("content_hash"))


@query("str04_author_digest", "SELECT event_id, sha256(CASE WHEN user_id % 4 <> 0 THEN user_id::VARCHAR END) AS author FROM events")
def str04_author_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", T.digest(F.when(F.col("user_id") % 4 != 0, F.col("user_id").cast("string"))).alias("author"))


@query("str14_embedding_text", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type || chr(10) || p_name END AS t FROM part")
def str14_embedding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.embedding_text(F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).otherwise(""), F.col("p_name")).alias("t"))


@query("str15_clip", "SELECT conv_id, turn, CASE WHEN length(f) > 80 THEN rtrim(substr(f, 1, 80)) || '…' ELSE f END AS t FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS f FROM conversations)")
def str15_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.clip(F.col("text"), 80).alias("t"))


@query("str13_locators", """SELECT page_id, CASE WHEN contains(base, '?') THEN base || '&page=3' ELSE base END || frag AS u
 FROM (SELECT page_id, CASE WHEN contains(url, '#') THEN substr(url, 1, instr(url, '#') - 1) ELSE url END AS base, CASE WHEN contains(url, '#') THEN substr(url, instr(url, '#')) ELSE '' END AS frag FROM pages)""")
def str13_locators(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, fragment = F.substring_index("url", "#", 1), F.regexp_extract("url", "#.*$", 0)
    query_ = F.when(F.contains(base, F.lit("?")), F.lit("&token=abc&page=3")).otherwise(F.lit("?api_key=xyz"))
    return table(spark, sf_dir, "pages").select("page_id", T.without_secrets(F.concat(base, query_, fragment)).alias("u"))


@query("dt01_month_windows", """WITH w AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS ws, (date_trunc('month', o_orderdate) + to_months(CAST(o_custkey % 4 + 1 AS INTEGER)))::DATE AS we FROM orders)
 SELECT o_orderkey, (unnest(range(ws::TIMESTAMP, we::TIMESTAMP, INTERVAL 1 MONTH)))::DATE AS month FROM w""")
def dt01_month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(D.months(start, F.add_months(start, (F.col("o_custkey") % 4 + 1).cast("int")))).alias("month"))


@query("dt02_halves", "SELECT o_orderkey, ws AS a, (ws + to_months(n // 2))::DATE AS b, (ws + to_months(n))::DATE AS c FROM (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS ws, CAST(o_custkey % 6 + 2 AS INTEGER) AS n FROM orders)")
def dt02_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    half = D.halves(F.col("ws"), F.col("we"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", start.alias("ws"), F.add_months(start, (F.col("o_custkey") % 6 + 2).cast("int")).alias("we"))
    return rows.select("o_orderkey", half[0]["window_start"].alias("a"), half[0]["window_end"].alias("b"), half[1]["window_end"].alias("c"))


@query("dt05_complete_periods", """SELECT o_orderkey, len(list_filter(range(1990, 2010), lambda y: a <= make_date(y, 1, 1) AND b >= make_date(y, 12, 31))) AS years, (a <= date_trunc('month', a + 40) AND b >= last_day(a + 40)) AS full_month
 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_custkey % 900 AS INTEGER) AS b FROM orders)""")
def dt05_complete_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"), "o_custkey")
    rows = rows.withColumn("b", F.date_add("a", (F.col("o_custkey") % 900).cast("int")))
    return rows.select("o_orderkey", F.size(D.complete_years(F.col("a"), F.col("b"))).cast("bigint").alias("years"), D.is_complete_month(F.trunc(F.date_add("a", 40), "MM"), F.col("a"), F.col("b")).alias("full_month"))


@query("dt06_date_parse", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate::DATE END AS d FROM orders")
def dt06_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    raw = F.element_at(F.array(F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy/MM/dd"), F.concat(F.year(day).cast("string"), F.lit("-02-30")), F.date_format(day, "yyyyMMdd"), F.lit("some day"), F.lit(None).cast("string")), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", D.iso_date(raw).alias("d"))


@query("dt03_month_buckets", "SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1")
def dt03_month_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(D.utc_month(F.col("o_orderdate")).alias("month")).agg(F.count("*").alias("n"))


@query("dt08_epoch_seconds", "SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS s FROM orders")
def dt08_epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", D.epoch_seconds(F.col("o_orderdate").cast("date")).alias("s"))


@query("json01_path_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json01_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", P.path(F.col("props"), "$.k", "bigint").alias("k"))


@query("flt05_path_predicates", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-03' AND '2024-01-20' AND CAST(json_extract(props, '$.k') AS BIGINT) < 50")
def flt05_path_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view") & day.between("2024-01-03", "2024-01-20") & (P.path(F.col("props"), "$.k", "bigint") < 50)).select("event_id")


@query("agg27_sum_of_values", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS total FROM events")
def agg27_sum_of_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = F.map_concat(F.from_json("props", "map<string,bigint>"), F.create_map(F.lit("one"), F.lit(1).cast("bigint")))
    return table(spark, sf_dir, "events").select("event_id", P.sum_of_values(counts).alias("total"))


def _inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted indexes by p_partkey % 8: of a name's words, repeated and tied words, and six broken or empty ones."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    words = F.transform(F.split("p_name", " "), lambda w, i: F.concat(quoted(w), F.lit(":["), i.cast("string"), F.lit("]")))
    whole = F.concat(F.lit("{"), F.array_join(words, ","), F.lit("}"))
    again = F.concat(F.lit("{"), quoted(F.col("p_type")), F.lit(":[1],"), quoted(F.col("p_brand")), F.lit(":[0,2]}"))
    tied = F.concat(F.lit('{"z":[0],'), quoted(F.col("p_brand")), F.lit(":[0]}"))
    cases = F.array(whole, again, tied, F.lit("{}"), F.lit('{"a":[0.5]}'), F.lit('{"a":[null,1]}'), F.lit('{"a":["0"],"b":[1]}'), F.lit("no index"))
    return table(spark, sf_dir, "part").select("p_partkey", F.element_at(cases, (F.col("p_partkey") % 8 + 1).cast("int")).alias("inverted"))


@query("arr01_abstracts", "SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN p_brand || ' ' || p_type || ' ' || p_brand WHEN 2 THEN p_brand || ' z' END AS abstract FROM part")
def arr01_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inverted(spark, sf_dir).select("p_partkey", P.abstract(F.col("inverted")).alias("abstract"))


@query("arr02_lenient_abstracts", "SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN p_brand || ' ' || p_type || ' ' || p_brand WHEN 2 THEN p_brand || ' z' WHEN 3 THEN '' WHEN 4 THEN '' WHEN 5 THEN 'a' WHEN 6 THEN 'b' END AS abstract FROM part")
def arr02_lenient_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inverted(spark, sf_dir).select("p_partkey", P.lenient_abstract(F.col("inverted")).alias("abstract"))


@query("json03_canonical", "SELECT event_id, '{\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS canonical FROM events")
def json03_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", P.canonical(F.col("props")).alias("canonical"))


@query("json04_work_identity", "SELECT event_id, sha256('{\"k\":' || k || '}') AS content_hash, sha256('[\"works\",\"' || event_id || '\",2,\"' || sha256('{\"k\":' || k || '}') || '\"]') AS version_id FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)")
def json04_work_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", P.content_identity(F.col("event_id").cast("string"), P.canonical(F.col("props"))).alias("i"))
    return rows.select("event_id", "i.content_hash", "i.version_id")


@query("hash01_cache_uuid", r"""WITH n AS (SELECT doc_id, sha1('\x6B\xA7\xB8\x11\x9D\xAD\x11\xD1\x80\xB4\x00\xC0\x4F\xD4\x30\xC8'::BLOB || encode(sha256(text) || '|model|1|plain')) AS h FROM documents)
 SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', instr('0123456789abcdef', substr(h, 17, 1)) % 4 + CASE WHEN instr('0123456789abcdef', substr(h, 17, 1)) % 4 = 0 THEN 4 ELSE 0 END, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id FROM n""")
def hash01_cache_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", P.name_uuid(P.cache_name(F.col("text"), "model", "1", "plain")).alias("point_id"))


@query("math01_geometric_mean", "SELECT l_returnflag, round(exp(avg(ln(l_quantity))), 6) AS g FROM lineitem GROUP BY 1")
def math01_geometric_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.exp(F.avg(F.ln("l_quantity"))), 6).alias("g"))
