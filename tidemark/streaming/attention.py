"""Streaming form of the attention cube, and current versions as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def daily_attention(events: DataFrame, lateness: str = "2 days", window: str = "1 day") -> DataFrame:
    """event_type, day, mentions, engagement per window; late rows beyond the watermark are dropped.

    Works on a stream and, without the watermark's effect, on a batch.
    """
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    out = stamped.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("mentions"), F.sum("value").alias("engagement"))
    return out.select("event_type", F.col("w.start").cast("date").alias("day"), "mentions", "engagement")


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = "2 days") -> DataFrame:
    """user_id, session_start, session_end, n per session of activity."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    out = stamped.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def _pointers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose pointer is complete."""
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(f"{path}/pointers")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    return sorted(int(x.getPath().getName()) for x in system.listStatus(root) if system.exists(files.Path(x.getPath(), "_SUCCESS")))


def _versions(spark: SparkSession, path: str, number: int) -> dict[int, int]:
    """The version of each bucket; as many rows as there are buckets."""
    return {r["bucket"]: r["version"] for r in spark.read.parquet(f"{path}/pointers/{number:012d}").collect()}


def _state(spark: SparkSession, path: str, versions: dict[int, int], schema) -> DataFrame:
    paths = [f"{path}/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that the last complete batch left."""
    done = _pointers(spark, path)
    return _state(spark, path, _versions(spark, path, done[-1]) if done else {}, schema)


def upsert_batches(path: str, keys: list[str], version: str, buckets: int = 64):
    """A foreachBatch function that keeps one current row per key; replaying a batch changes nothing.

    Keys are dealt to buckets. A batch rewrites the buckets it touches into a version folder of its own and
    then writes a pointer of its own, which says which version of each bucket holds. Nothing that a complete
    pointer names is ever overwritten, so :func:`current` always finds a whole state.
    """
    from tidemark.sources.sinks import merged

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [n for n in _pointers(spark, path) if n < number]
        versions = _versions(spark, path, before[-1]) if before else {}
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
        touched = [r["bucket"] for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` rows
        old = _state(spark, path, {b: v for b, v in versions.items() if b in touched}, batch.schema)
        rows = merged(old, batch, keys, version).select("*", bucket)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number}")
        held = sorted((versions | dict.fromkeys(touched, number)).items())
        spark.createDataFrame(held, "bucket int, version bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/pointers/{number:012d}")

    return write


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes pointers before the last ``keep`` complete ones and versions that none of the kept names; returns the number of folders.

    Only call it between batches; readers of a kept pointer find all that it names.
    """
    done = _pointers(spark, path)
    kept = done[-keep:]
    if not kept:
        return 0
    named = {v for n in kept for v in _versions(spark, path, n).values()}
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    held = [int(x.getPath().getName().partition("=")[2]) for x in system.listStatus(root) if x.getPath().getName().startswith("version=")]
    # a version after the last pointer may be that of a batch that is still to be completed
    lost = [f"{path}/version={v}" for v in held if v not in named and v <= kept[-1]] + [f"{path}/pointers/{n:012d}" for n in done if n < kept[0]]
    for at in lost:
        system.delete(files.Path(at), True)
    return len(lost)
