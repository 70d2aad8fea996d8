"""Topics: fit port with fitters by density and by k-means, keywords by class-based tf-idf, composition hashes, sizes, labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.sources.durable import stored


class TopicFitter(Protocol):
    """Assigns rows of (idx, vector) to topics; -1 is an outlier."""

    def fit(self, vectors: DataFrame) -> DataFrame: ...


class KMeansFitter:
    """A plainer fitter for a known number of topics: k-means on unit vectors, the farthest share of each cluster becoming outliers."""

    def __init__(self, k: int, outlier_share: float = 0.05, seed: int = 42):
        self.k, self.outlier_share, self.seed = k, outlier_share, seed

    def fit(self, vectors: DataFrame) -> DataFrame:
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        from tidemark.operators.vectors import dot, unit

        rows = vectors.withColumn("u", unit(F.col("vector"))).withColumn("features", array_to_vector("u"))
        model = KMeans(k=self.k, seed=self.seed).fit(rows)
        centers = vectors.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "topic int, c array<double>")
        near = model.transform(rows).withColumnRenamed("prediction", "topic").join(F.broadcast(centers), "topic")
        near = near.withColumn("d", 1 - dot(F.col("u"), F.col("c")))
        cut = near.groupBy("topic").agg(F.percentile_approx("d", 1 - self.outlier_share, 10000).alias("cut"))
        return near.join(F.broadcast(cut), "topic").select("idx", F.when(F.col("d") > F.col("cut"), -1).otherwise(F.col("topic")).alias("topic"))


class DensityFitter:
    """The fitter of the topic stage: neighbour graph by cosine, two-dimensional layout, density clusters of the laid out points.

    Lists that the clusters are found by are twice min_cluster_size long, as a small component's least edge may lie beyond its
    points' first min_samples neighbours.
    """

    def __init__(self, n_neighbors: int = 15, min_cluster_size: int = 15, min_samples: int | None = None, metric: str = "cosine", seed: int = 42):
        self.n_neighbors, self.min_cluster_size, self.min_samples, self.metric, self.seed = n_neighbors, min_cluster_size, min_samples, metric, seed

    def fit(self, vectors: DataFrame) -> DataFrame:
        from tidemark.operators import density, layout, neighbours
        from tidemark.operators.vectors import unit

        x = F.col("vector").cast("array<double>")
        points = vectors.where("vector is not null").select(F.col("idx").cast("long").alias("id"), (unit(x) if self.metric == "cosine" else x).alias("x"))
        lists = neighbours.neighbours(vectors, self.n_neighbors, metric=self.metric, seed=self.seed)
        flat = layout.layout(lists, points, seed=self.seed)
        near = neighbours.neighbours(flat, 2 * self.min_cluster_size, "id", "y", "euclidean", seed=self.seed)
        found = density.clusters(near, flat.withColumnRenamed("y", "x"), self.min_cluster_size, self.min_samples)
        out = vectors.select("idx").join(found.withColumnRenamed("id", "idx"), "idx", "left")
        return out.select("idx", F.coalesce("topic", F.lit(-1)).alias("topic"))


def keywords(tokens: DataFrame, k: int = 10) -> DataFrame:
    """topic, term, weight, rank by class-based tf-idf: tf in the topic x ln(1 + A / f), A the mean words per topic; tokens: topic, term.

    Tokens are read once, for tf, which is written; all else is derived from it.
    """
    tf = stored(tokens.groupBy("topic", "term").agg(F.count("*").alias("tf")), "tf")
    f = tf.groupBy("term").agg(F.sum("tf").alias("f"))
    size = tf.groupBy("topic").agg(F.sum("tf").alias("n"))
    mean = size.agg(F.avg("n")).first()[0]
    rows = tf.join(f, "term").join(size, "topic")
    rows = rows.withColumn("weight", F.col("tf") / F.col("n") * F.ln(1 + F.lit(mean) / F.col("f")))
    w = W.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("topic", "term", "weight", "rank")


def composition(members: DataFrame, topic: str = "topic", work: str = "work_id") -> DataFrame:
    """topic, size, composition_hash: SHA-256 of the sorted member ids (as text), one a line.

    A topic's ids meet in one row, so a topic may hold 2 GB of ids, some 100 million.
    """
    ids = F.sort_array(F.collect_list(F.col(work).cast("string")))
    return members.groupBy(topic).agg(F.count("*").alias("size"), F.sha2(F.array_join(ids, "\n"), 256).alias("composition_hash"))


def outlier_rate(assignments: DataFrame) -> DataFrame:
    flag = F.col("is_outlier").cast("int")
    return assignments.agg(F.count("*").alias("works"), F.sum(flag).cast("bigint").alias("outliers"), F.avg(flag).alias("outlier_rate"))


def sample_ids(size: Column, members: Column, representatives: Column, sample: int) -> Column:
    """All members of a topic of fewer than three, else its first distinct representatives."""
    return F.when(size < 3, members).otherwise(F.slice(F.array_distinct(representatives), 1, sample))


def skip_label(status: Column, sampled: Column, wanted: Column, available: Column) -> Column:
    """A label is done if it succeeded and its sample is full or cannot grow."""
    return F.coalesce((status == "succeeded") & ((sampled >= wanted) | (sampled >= available)), F.lit(False))


SINGLE = 1


def summaries(works: DataFrame, cached: DataFrame, generate: Callable[[str], str], template: str, attempts: int = 3) -> DataFrame:
    """topic, work_id, summary of sampled works: cached ones as they are, others by the port from ``template`` (with {title}, {abstract}).

    works: topic, work_id, title, abstract. cached: topic, work_id, summary. A work on which the port fails for good is left out.
    """
    keys = ["topic", "work_id"]
    fresh = works.join(cached.select(*keys), keys, "left_anti")
    prompt = F.replace(F.replace(F.lit(template), F.lit("{title}"), F.coalesce("title", F.lit(""))), F.lit("{abstract}"), F.coalesce("abstract", F.lit("")))
    kinds = dict(works.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            part["summary"] = [tried(generate, p, attempts) for p in part["prompt"]]
            yield part.loc[part["summary"].notna(), [*keys, "summary"]]

    made = fresh.select(*keys, prompt.alias("prompt")).mapInPandas(run, f"topic {kinds['topic']}, work_id {kinds['work_id']}, summary string")
    return cached.join(works.select(*keys), keys, "left_semi").select(*keys, "summary").unionByName(made)


def tried(generate: Callable[[str], str], prompt: str, attempts: int) -> str | None:
    """The port's text, stripped; null if it is empty or each attempt raises ValueError."""
    for _ in range(attempts):
        try:
            return generate(prompt).strip() or None
        except ValueError:
            continue
    return None


def token_counts(text: Column, count_tokens: Callable[[str], int]) -> Column:
    """Tokens of a text by the tokenizer port; null stays null."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else count_tokens(t) for t in texts], dtype="Int64")

    return counted(text)


def tokenizer_file(path: str) -> Callable[[str], int]:
    """A counting port over a public tokenizer's vocabulary file (tokenizer.json); each worker loads it once."""
    held: dict[str, object] = {}

    def count(text: str) -> int:
        if path not in held:
            from tokenizers import Tokenizer

            held[path] = Tokenizer.from_file(path)
        return len(held[path].encode(text).ids)

    return count


def windows(texts: list[str], count_tokens: Callable[[str], int], limit: int, joint: str = "\n\n") -> list[str]:
    """Texts joined in order into windows of at most limit tokens; a longer text is a window of its own."""
    out: list[str] = []
    for text in texts:
        if out and count_tokens(out[-1] + joint + text) <= limit:
            out[-1] += joint + text
        else:
            out.append(text)
    return out


def headlines(rows: DataFrame, generate: Callable[[str], str], count_tokens: Callable[[str], int], template: str, limit: int, attempts: int = 3) -> DataFrame:
    """topic, headline, chunk_count, status from each topic's summaries (with {summaries} in the template).

    rows: topic, position, summary. All summaries in one prompt if that fits limit tokens; else a headline per window of
    summaries, and a final one from these. chunk_count is the number of windows. A topic's sample is bounded by its size.
    """

    def one(texts: list[str]) -> tuple[str | None, int]:
        whole = template.replace("{summaries}", "\n\n".join(texts))
        if count_tokens(whole) <= limit:
            return tried(generate, whole, attempts), SINGLE
        parts = windows(texts, count_tokens, limit - count_tokens(template.replace("{summaries}", "")))
        if len(parts) == 1:
            return tried(generate, template.replace("{summaries}", parts[0]), attempts), SINGLE
        heads = [tried(generate, template.replace("{summaries}", p), attempts) for p in parts]
        if None in heads:
            return None, len(parts)
        return tried(generate, template.replace("{summaries}", "\n\n".join(heads)), attempts), len(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [one(list(texts)) for texts in part["texts"]]
            yield pd.DataFrame({"topic": part["topic"], "headline": [h for h, _ in found], "chunk_count": [n for _, n in found], "status": ["succeeded" if h else "failed" for h, _ in found]})

    lists = rows.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "summary"))), lambda x: x["summary"]).alias("texts"))
    return lists.mapInPandas(run, f"topic {dict(rows.dtypes)['topic']}, headline string, chunk_count int, status string")


def label(topics: DataFrame, generate: Callable[[str], str], attempts: int = 3) -> DataFrame:
    """topic, headline, status by a text-generation port, retried on ValueError; topics: topic, prompt."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = [tried(generate, prompt, attempts) for prompt in part["prompt"]]
            yield pd.DataFrame({"topic": part["topic"], "headline": out, "status": ["succeeded" if t else "failed" for t in out]})

    return topics.select("topic", "prompt").mapInPandas(run, f"topic {dict(topics.dtypes)['topic']}, headline string, status string")


def adopted(runs: DataFrame) -> DataFrame:
    """The latest succeeded run of every request; runs: run_id, request_hash, status, finished_at."""
    done = runs.where("status = 'succeeded'").groupBy("request_hash").agg(F.max(F.struct("finished_at", "run_id")).alias("run"))
    return done.select("request_hash", F.col("run.run_id").alias("run_id"), F.col("run.finished_at").alias("finished_at"))
