"""Vectors and topic keywords over embeddings and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import topics as T
from tidemark.operators import vectors as V
from tidemark.plans.registry import query, table

UNIT = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), u AS (SELECT vec_id, label, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12)) AS v FROM e),
 d AS (SELECT label, i, avg(v[i]) AS m FROM u, range(1, 65) t(i) GROUP BY ALL), c AS (SELECT label, list(m ORDER BY i) AS c FROM d GROUP BY label), n AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_dot_product(c, c))) AS c FROM c)"""


@query("vec01_centroids", f"{UNIT} SELECT label, round(c[1], 6) AS first, round(c[64], 6) AS last, round(list_dot_product(c, c), 6) AS norm FROM n")
def vec01_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return c.select("label", F.round(F.element_at("centroid", 1), 6).alias("first"), F.round(F.element_at("centroid", 64), 6).alias("last"), F.round(V.dot(F.col("centroid"), F.col("centroid")), 6).alias("norm"))


@query("top04_nearest_to_centroid", f"{UNIT} SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY list_dot_product(v, c) DESC, vec_id) AS rank FROM u JOIN n USING (label) QUALIFY rank <= 15")
def top04_nearest_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.nearest_to_centroid(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding").select("label", "vec_id", F.col("rank").cast("bigint").alias("rank"))


@query("vec02_representatives", UNIT.replace("FROM embeddings", "FROM embeddings WHERE vec_id % 3 <> 0") + " SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY list_dot_product(v, c) DESC, vec_id) AS rank FROM u JOIN n USING (label) QUALIFY rank <= 1000")
def vec02_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the members has no vector: they are skipped, also where the list is not full."""
    points = table(spark, sf_dir, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")))
    return V.nearest_to_centroid(points, "label", "vec_id", "embedding", 1000).select("label", "vec_id", F.col("rank").cast("bigint").alias("rank"))


@query("vec03_short_lists", f"""{UNIT}, near AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY list_dot_product(v, c) DESC, vec_id) AS rank FROM u JOIN n USING (label)), s AS (SELECT label, count(*) AS size, list(vec_id ORDER BY vec_id) AS m FROM u GROUP BY 1),
 f AS (SELECT label, list(vec_id ORDER BY rank) AS found FROM near JOIN s USING (label) WHERE rank <= least(15, size) GROUP BY label), o AS (SELECT label, CASE label % 3 WHEN 0 THEN list_slice(m, 1, 20) WHEN 1 THEN list_slice(m, 1, 4) ELSE [] END AS own, found FROM s JOIN f USING (label))
 SELECT label, array_to_string(CASE WHEN len(own) < 15 AND len(found) > len(own) THEN found ELSE own END, ',') AS items FROM o""")
def vec03_short_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels have long, short and no representatives; what is short is filled from the nearest members if these are more."""
    points = table(spark, sf_dir, "embeddings")
    own = points.groupBy("label").agg(F.count("*").alias("size"), F.sort_array(F.collect_list("vec_id")).alias("m"))
    lists = own.select("label", "size", F.when(F.col("label") % 3 == 0, F.slice("m", 1, 20)).when(F.col("label") % 3 == 1, F.slice("m", 1, 4)).alias("items"))
    near = V.nearest_to_centroid(points, "label", "vec_id", "embedding")
    return V.backfill(lists, near, "label", "vec_id", 15).select("label", F.array_join("items", ",").alias("items"))


@query("vec04_cached_embedding", "SELECT vec_id AS point_id, 64 AS n FROM embeddings WHERE vec_id % 2 = 0 AND vec_id IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, 2 FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE vec_id % 2 = 0)")
def vec04_cached_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("point_id"), "text")
    cached = table(spark, sf_dir, "embeddings").where("vec_id % 2 = 0").select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"))
    out = V.embed_missing(texts, cached, lambda batch: [[float(len(t)), 1.0] for t in batch])
    return out.select("point_id", F.size("vector").alias("n"))


@query("vec06_aligned_matrix", "SELECT 999999 - vec_id AS idx, vec_id AS point_id, round(embedding[1]::DOUBLE, 6) AS x FROM embeddings")
def vec06_aligned_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"))
    plan = rows.select("point_id", (F.lit(999999) - F.col("point_id")).alias("idx"))
    return V.aligned(plan, rows).select("idx", "point_id", F.round(F.element_at("vector", 1).cast("double"), 6).alias("x"))


@query("ml02_topic_keywords", """WITH t AS (SELECT lang AS topic, unnest(string_split(trim(regexp_replace(lower(text), '[^\\pL\\pN]+', ' ', 'g')), ' ')) AS term FROM documents), tf AS (SELECT topic, term, count(*) AS tf FROM t WHERE term <> '' GROUP BY ALL),
 f AS (SELECT term, sum(tf) AS f FROM tf GROUP BY 1), s AS (SELECT topic, sum(tf) AS n FROM tf GROUP BY 1), a AS (SELECT avg(n) AS a FROM s), w AS (SELECT topic, term, tf::DOUBLE / n * ln(1 + a / f) AS weight FROM tf JOIN f USING (term) JOIN s USING (topic), a)
 SELECT topic, term, round(weight, 6) AS weight, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM w QUALIFY rank <= 10""")
def ml02_topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.text import normalize

    tokens = table(spark, sf_dir, "documents").select(F.col("lang").alias("topic"), F.explode(F.split(F.regexp_replace(normalize(F.col("text")), "_", " "), " ")).alias("term")).where("term <> ''")
    return T.keywords(tokens).select("topic", "term", F.round("weight", 6).alias("weight"), F.col("rank").cast("bigint").alias("rank"))


@query("arr04_keyword_line", """WITH t AS (SELECT lang AS topic, unnest(string_split(lower(text), ' ')) AS term FROM documents), c AS (SELECT topic, term, count(*) AS n FROM t WHERE term <> '' GROUP BY ALL), k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, term) <= 8)
 SELECT topic, string_agg(term, ', ' ORDER BY n DESC, term) AS keywords FROM k GROUP BY topic""")
def arr04_keyword_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window as W

    counts = table(spark, sf_dir, "documents").select(F.col("lang").alias("topic"), F.explode(F.split(F.lower("text"), " ")).alias("term")).where("term <> ''").groupBy("topic", "term").agg(F.count("*").alias("n"))
    first = counts.withColumn("rank", F.row_number().over(W.partitionBy("topic").orderBy(F.desc("n"), "term"))).where("rank <= 8")
    return first.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("keywords"))


@query("llm02_sample_ids", "SELECT label, CASE WHEN count(*) < 3 THEN string_agg(vec_id::VARCHAR, ',' ORDER BY vec_id) ELSE array_to_string(list_slice(list(vec_id ORDER BY vec_id), 1, 5), ',') END AS ids FROM embeddings GROUP BY label")
def llm02_sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.sort_array(F.collect_list("vec_id")).alias("m"))
    return rows.select("label", F.array_join(T.sample_ids(F.size("m"), F.col("m"), F.col("m"), 5), ",").alias("ids"))


@query("flt14_skip_labels", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 7 >= 5 OR o_orderkey % 7 >= o_custkey % 4)")
def flt14_skip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed")
    return table(spark, sf_dir, "orders").where(T.skip_label(status, F.col("o_orderkey") % 7, F.lit(5), F.col("o_custkey") % 4)).select("o_orderkey")


@query("ml01_topic_fit")
def ml01_topic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vector"))
    return T.DensityFitter().fit(rows)


@query("ml01_kmeans_fit")
def ml01_kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vector"))
    return T.KMeansFitter(10).fit(rows)


@query("ml01_neighbours", """WITH u AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12)) AS v FROM embeddings)
 SELECT a.vec_id AS id, b.vec_id AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(1 - list_dot_product(a.v, b.v), 12), b.vec_id) AS rank, round(1 - list_dot_product(a.v, b.v), 6) AS distance FROM u a JOIN u b ON a.vec_id <> b.vec_id QUALIFY rank <= 15""")
def ml01_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists are exact up to a block of points; the SQL compares all pairs."""
    from tidemark.operators.neighbours import neighbours

    found = neighbours(table(spark, sf_dir, "embeddings"), 15, "vec_id", "embedding")
    return found.select("id", "other", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))


@query("llm01_labels", """WITH t AS (SELECT lang AS topic, unnest(string_split(lower(text), ' ')) AS term FROM documents), c AS (SELECT topic, term, count(*) AS n FROM t WHERE term <> '' GROUP BY ALL)
 SELECT topic, upper(trim(term)) AS headline, 'succeeded' AS status FROM c QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n DESC, term) = 1""")
def llm01_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = arr04_keyword_line(spark, sf_dir).select("topic", F.col("keywords").alias("prompt"))
    return T.label(prompts, lambda prompt: prompt.split(", ")[0].upper())
