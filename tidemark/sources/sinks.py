"""Sinks over plain Parquet: publish once, append new, upsert, rebuild a slice. Several tables at once: :mod:`tidemark.sources.snapshots`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def fingerprint(df: DataFrame) -> str:
    """An order-free digest of rows: their count and the sums of two 64-bit hashes."""
    sums = [F.coalesce(F.sum(F.xxhash64(*seed, *df.columns).cast("decimal(38,0)")), F.lit(0)).alias(f"s{k}") for k, seed in enumerate(((), (F.lit("second"),)))]
    row = df.agg(F.count("*").alias("n"), *sums).first()
    return f"{row['n']}-{row['s0']}-{row['s1']}"


def publish(df: DataFrame, folder: str, failure: Callable[[str], None] = lambda stage: None) -> str:
    """Writes zstd Parquet under a name made of its content, checks the rows, and returns the path.

    The rows are written aside, read back and checked, and only then renamed, so a crash leaves no half
    output under the name. The same rows published again are found in place; a path is never overwritten.
    failure is called after the stages ``written`` and ``renamed``; tests break off there.
    """
    spark, mark = df.sparkSession, fingerprint(df)
    path = f"{folder}/part-{mark}"
    if not _exists(df, path):
        aside = f"{folder}/.aside-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(aside)
        _checked(spark.read.parquet(aside), df.columns, mark)
        failure("written")
        files = spark._jvm.org.apache.hadoop.fs
        system = files.Path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.rename(files.Path(aside), files.Path(path)):
            system.delete(files.Path(aside), True)  # somebody else has published it
        failure("renamed")
    _checked(spark.read.parquet(path), df.columns, mark)
    return path


def _checked(stored: DataFrame, columns: list[str], mark: str) -> None:
    if fingerprint(stored.select(*columns)) != mark:
        raise ValueError("immutable output conflict")


def write_once(spark: SparkSession, path: str, definition: str) -> None:
    """Keeps a definition, such as a scope's, under a path; the same one again changes nothing, another one raises."""
    one = spark.createDataFrame([(definition,)], "definition string").coalesce(1)
    if not _exists(one, f"{path}/_SUCCESS"):
        one.write.mode("overwrite").parquet(path)
    if [r[0] for r in spark.read.parquet(path).collect()] != [definition]:  # one row
        raise ValueError(f"{path} cannot be changed")


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Insert or ignore: rows whose key is stored are left out, repeated keys keep one row."""
    fresh = df.dropDuplicates(keys)
    if _exists(df, path):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(*keys), keys, "left_anti")
    fresh.write.mode("append").parquet(path)


def merged(stored: DataFrame, df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Upsert as a value: of stored and new rows the one with the greatest version per key, the new one on ties."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(df.withColumn("_new", F.lit(1)))
    w = W.partitionBy(*keys).orderBy(F.desc(version), F.desc("_new"))
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_new")


def rebuild(df: DataFrame, path: str, partition: str) -> None:
    """Replaces exactly the partitions that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def raw_receipts(bodies: DataFrame) -> DataFrame:
    """Bronze rows with the checksum and size of each raw body."""
    return bodies.withColumns({"sha256": F.sha2("body", 256), "size": F.octet_length("body")})
