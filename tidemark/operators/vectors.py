"""Dense vectors: unit norm, centroids, grouped nearest, cached embedding."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import BoundedSemaphore, Condition, Lock

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions.binding import let

FLOOR = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """The vector over its length, the length at least FLOOR."""
    return let(F.transform(vector, lambda x: x.cast("double")), lambda w: scaled(w, F.sqrt(dot(w, w))))


def scaled(vector: Column, length: Column) -> Column:
    """The vector over a length of at least FLOOR, which is worked out once."""
    return let(F.greatest(length, F.lit(FLOOR)), lambda n: F.transform(vector, lambda x: x / n))


def centroids(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """group, centroid, degenerate: the mean of unit vectors, normalised again. Sums are taken per dimension, map side first."""
    parts = vectors.select(group, F.posexplode(unit(F.col(vector))).alias("i", "x"))
    mean = parts.groupBy(group, "i").agg(F.avg("x").alias("m"))
    whole = mean.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("m"))
    size = F.sqrt(dot(F.col("m"), F.col("m")))
    return whole.select(group, scaled(F.col("m"), size).alias("centroid"), (size <= FLOOR).alias("degenerate"))


def nearest_to_centroid(vectors: DataFrame, group: str, order: str, vector: str, k: int = 15) -> DataFrame:
    """The k members of each group nearest to its centroid by cosine; ties keep the earlier row; a degenerate centroid takes the first k.

    Members without a vector (null or empty) are skipped; a group of such members alone has no row.
    """
    vectors = vectors.where(F.size(vector) > 0)
    rows = vectors.join(centroids(vectors, group, vector), group)
    sim = F.when(F.col("degenerate"), F.lit(0.0)).otherwise(dot(unit(F.col(vector)), F.col("centroid")))
    rows = rows.withColumn("similarity", sim)
    w = W.partitionBy(group).orderBy(F.desc("similarity"), order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(group, order, "rank", "similarity")


def backfill(lists: DataFrame, near: DataFrame, group: str, item: str, target: int) -> DataFrame:
    """group, items: lists shorter than target and their group's size take the nearest members instead, where these are more.

    lists: group, size, items. near: group, item, rank, as :func:`nearest_to_centroid` gives them; members without a vector are not in it.
    """
    own = F.array_distinct(F.coalesce("items", F.array().cast(dict(lists.dtypes)["items"])))
    want = F.least(F.lit(target), F.col("size"))
    short = lists.select(group, own.alias("own"), want.alias("want")).where(F.size("own") < F.col("want"))
    found = near.join(short.select(group, "want"), group).where(F.col("rank") <= F.col("want")).groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", item))), lambda x: x[item]).alias("found"))
    both = lists.select(group, own.alias("own")).join(found, group, "left")
    return both.select(group, F.when(F.size("found") > F.size("own"), F.col("found")).otherwise(F.col("own")).alias("items"))


def failover(endpoints: list[Callable[[list[str]], list[list[float]]]]) -> Callable[[list[str]], list[list[float]]]:
    """One port over several: an endpoint that raises OSError is left out from then on; ValueError concerns the text and is passed on."""
    left = list(endpoints)

    def embed(batch: list[str]) -> list[list[float]]:
        while left:
            try:
                return left[0](batch)
            except OSError:
                left.pop(0)
        raise RuntimeError("no embedding endpoint is left")

    return embed


def pooled(endpoints: list[Callable[[list[str]], list[list[float]]]], concurrency: int, batch: int = 32) -> Callable[[list[str]], list[list[float] | None]]:
    """One port over several endpoints that answer at the same time: all waiting batches stand in one queue, from which the endpoints that
    are left take the next one, at most ``concurrency`` requests at once.

    An endpoint that raises OSError is dropped for all; its batch goes back to the queue. ValueError concerns a text: the batch is
    tried text by text, and a text that fails alone gets None. Texts that no endpoint is left for raise a RuntimeError.
    """
    left = list(range(len(endpoints)))

    def embed(texts: list[str]) -> list[list[float] | None]:
        found: list[list[float] | None] = [None] * len(texts)
        waiting, lock = deque((k, min(k + batch, len(texts))) for k in range(0, len(texts), batch)), Lock()
        seats, busy = BoundedSemaphore(concurrency), Condition(lock)
        open_ = [0]

        def asked(n: int, a: int, b: int) -> None:
            with seats:
                try:
                    found[a:b] = endpoints[n](texts[a:b])
                except ValueError:
                    if b - a > 1:
                        with lock:
                            waiting.extend((k, k + 1) for k in range(a, b))

        def work(n: int) -> None:
            while True:
                with lock:
                    while not waiting and open_[0] and n in left:
                        busy.wait()  # another endpoint's batch may come back
                    if n not in left or not waiting:
                        return
                    a, b = waiting.popleft()
                    open_[0] += 1
                try:
                    asked(n, a, b)
                except OSError:
                    with lock:
                        waiting.appendleft((a, b))
                        left.remove(n)
                finally:
                    with lock:
                        open_[0] -= 1
                        busy.notify_all()

        if left and texts:
            with ThreadPoolExecutor(len(left)) as pool:
                for done in [pool.submit(work, n) for n in list(left)]:
                    done.result()
        if waiting:
            raise RuntimeError("no embedding endpoint is left")
        return found

    return embed


def matching(table: DataFrame, first, last, column: str = "published") -> DataFrame:
    """The rows of a vector table whose payload column lies between two values, both included; count them or select from them."""
    return table.where(F.col(column).between(F.lit(first), F.lit(last)))


def embed_missing(texts: DataFrame, cached: DataFrame, embed: Callable[[list[str]], list[list[float]]], key: str = "point_id", text: str = "text") -> DataFrame:
    """key, vector for all texts: stored vectors where there are, the port's for the rest (null where it fails on one)."""
    missing = texts.join(cached.select(key), key, "left_anti").dropDuplicates([key])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            try:
                vectors: list = embed(part[text].tolist())
            except ValueError:
                vectors = []
                for one in part[text]:
                    try:
                        vectors += embed([one])
                    except ValueError:
                        vectors.append(None)
            yield pd.DataFrame({key: part[key], "vector": vectors})

    fresh = missing.select(key, text).mapInPandas(run, f"{key} {dict(texts.dtypes)[key]}, vector array<double>")
    return cached.select(key, F.col("vector").cast("array<double>").alias("vector")).join(texts.select(key), key, "left_semi").unionByName(fresh)


def aligned(plan: DataFrame, vectors: DataFrame, key: str = "point_id") -> DataFrame:
    """plan rows in their order with their vector; raises if one is missing."""
    lost = plan.join(vectors.where("vector is not null"), key, "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"no vector for {lost[0][key]}")
    return plan.join(vectors, key).orderBy("idx")

