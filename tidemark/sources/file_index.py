"""An index of many files: ranges and Bloom filters of a key, a small table that picks the files to open before a scan.

The index has one row a file with the key's least and greatest value, and one row for each 64-bit word of the file's Bloom filter
that is not zero. A lookup reads the ranges and the ``HASHES`` words that its value asks for, and opens only files that may
hold the value; a file that holds it is never left out. Both are made by one scan of the key column, whose rows are reduced to
words before anything is shuffled.

Defined cases: null keys are not indexed and not found; a value that no file may hold gives an empty table with the files'
columns; a file added later is found only after the index is built again or extended by :func:`build` over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits set for a key, and words of a file's filter: 2**20 bits, about ten a key for 100,000 keys a file.
HASHES, WORDS = 5, 1 << 14


def _places(key: Column, words: int) -> Column:
    """The bits of a key as (word, mask), by double hashing."""
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit("step"))
    bits = F.sequence(F.lit(0), F.lit(HASHES - 1))
    at = F.transform(bits, lambda k: F.pmod(one.bitwiseAND(0x7FFFFFFFFFFF) + k * two.bitwiseAND(0x7FFFFFFFFFFF), F.lit(64 * words)))
    return F.transform(at, lambda b: F.struct((b / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (b % 64).cast("int")).alias("mask")))


def build(spark: SparkSession, paths: list[str], key: str, folder: str, words: int = WORDS) -> None:
    """Writes the index of the files under paths to a folder; more files may be indexed into the same one."""
    rows = spark.read.parquet(*paths).select(F.col(key).alias("key"), F.col("_metadata.file_path").alias("file")).where("key is not null")
    rows.groupBy("file").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.lit(words).alias("words")).write.mode("append").parquet(f"{folder}/ranges")
    bits = rows.select("file", F.explode(_places(F.col("key"), words)).alias("b")).groupBy("file", F.col("b.word").alias("word")).agg(F.bit_or("b.mask").alias("bits"))
    # by word, so that a lookup's few words lie in few row groups
    bits.sortWithinPartitions("word").write.mode("append").parquet(f"{folder}/bits")


def candidates(spark: SparkSession, folder: str, value) -> list[str]:
    """The files that may hold a value: those whose range and filter admit it."""
    ranges = spark.read.parquet(f"{folder}/ranges").where(F.lit(value).between(F.col("lo"), F.col("hi")))
    words = [r["words"] for r in ranges.select("words").distinct().collect()]  # one unless it was built with several
    found: list[str] = []
    for n in words:
        kind = ranges.schema["lo"].dataType
        asked = [(b["word"], b["mask"]) for b in spark.range(1).select(F.explode(_places(F.lit(value).cast(kind), n)).alias("b")).select("b.*").distinct().collect()]
        hit = F.lit(False)
        for word, mask in asked:
            hit = hit | ((F.col("word") == word) & (F.col("bits").bitwiseAND(mask) != 0))
        words_of = spark.read.parquet(f"{folder}/bits").where(F.col("word").isin([w for w, _ in asked]))
        every = F.lit(True)
        for word, mask in asked:
            every = every & F.max(F.coalesce((F.col("word") == word) & (F.col("bits").bitwiseAND(mask) != 0), F.lit(False)))
        held = words_of.where(hit).groupBy("file").agg(every.alias("all")).where("all")
        found += [r["file"] for r in ranges.where(F.col("words") == n).join(held, "file").select("file").collect()]
    return sorted(found)


def lookup(spark: SparkSession, folder: str, paths: list[str], key: str, value) -> DataFrame:
    """Rows with one key value and the file each comes from; only the index's candidates are opened."""
    files = candidates(spark, folder, value)
    if not files:
        schema = spark.read.parquet(*paths).schema
        return spark.createDataFrame([], schema).withColumn("filename", F.lit(None).cast("string"))
    return spark.read.parquet(*files).select("*", F.col("_metadata.file_path").alias("filename")).where(F.col(key) == value)
