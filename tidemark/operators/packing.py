"""Row ranges and sequential packing: coverage gaps, bounded chunks, token windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult
from pyspark.sql.window import Window as W


def coverage_gaps(ranges: DataFrame, totals: DataFrame, key: str = "file") -> DataFrame:
    """key, gap_start, gap_end: uncovered half-open ranges of each file.

    ranges: key, start, count. totals: key, total. Zero or negative counts, overlaps and ranges
    beyond the total raise when the result is computed.
    """
    w = W.partitionBy(key).orderBy("start", "count")
    rows = ranges.withColumn("end", F.col("start") + F.col("count")).join(totals, key)
    rows = rows.withColumn("before", F.coalesce(F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    wrong = (F.col("count") <= 0) | (F.col("start") < F.col("before")) | (F.col("end") > F.col("total"))
    checked = rows.withColumn("before", F.when(wrong, F.raise_error(F.lit("invalid committed source coverage")).cast("bigint")).otherwise(F.col("before")))
    inner = checked.select(key, F.col("before").alias("gap_start"), F.col("start").alias("gap_end"))
    tail = totals.join(ranges.groupBy(key).agg(F.max(F.col("start") + F.col("count")).alias("end")), key, "left")
    last = tail.select(key, F.coalesce("end", F.lit(0)).alias("gap_start"), F.col("total").alias("gap_end"))
    return inner.unionByName(last).where("gap_start < gap_end")


def files_with_gaps(ranges: DataFrame, totals: DataFrame, key: str = "file") -> DataFrame:
    """files, incomplete: how many files committed ranges leave a gap in."""
    gaps = coverage_gaps(ranges, totals, key).select(key).distinct().withColumn("gap", F.lit(1))
    return totals.join(gaps, key, "left").agg(F.count("*").alias("files"), F.count("gap").alias("incomplete"))


class Packer:
    """Greedy packing in order: an item opens a new pack if the current one is full by count or would exceed max_size."""

    def __init__(self, max_items: int, max_size: int):
        self.max_items, self.max_size = max_items, max_size
        self.pack, self.items, self.size = -1, 0, 0

    def add(self, size: int) -> bool:
        """Whether the item opens a new pack; a single oversized item is a pack of its own."""
        fresh = self.pack < 0 or self.items == self.max_items or self.size + size > self.max_size
        self.pack, self.items, self.size = (self.pack + 1, 1, size) if fresh else (self.pack, self.items + 1, self.size + size)
        return fresh


def pack(sizes: Column, max_items: int, max_size: int) -> Column:
    """The number of the pack, from 0, that each item of an array of sizes falls into. Linear in the array; an Arrow batch at a time."""

    @F.pandas_udf("array<int>")
    def packs(lists: pd.Series) -> pd.Series:
        def run(own) -> list[int] | None:
            if own is None:
                return None
            packer, numbers = Packer(max_items, max_size), []
            for x in own:
                packer.add(int(x))
                numbers.append(packer.pack)
            return numbers

        return lists.map(run)

    return packs(sizes)


def bounded_chunks(records: DataFrame, key: str, order: str, size: str, max_items: int, max_size: int, max_record: int) -> DataFrame:
    """key, chunk, first, n, size of the chunks of each file; a record above max_record raises.

    Files are sorted within partitions and folded as they stream by, so a file of any length takes
    the memory of one batch; what crosses the network are keys, order and sizes.
    """
    checked = F.when(F.col(size) > max_record, F.raise_error(F.lit("expanded record exceeds limit")).cast("bigint")).otherwise(F.col(size).cast("bigint"))
    rows = records.select(key, F.col(order).alias("o"), checked.alias("s"))
    kinds = dict(rows.dtypes)
    names = [key, "chunk", "first", "n", "size"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, own, now = Packer(max_items, max_size), None, None
        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.schema.types[0], pa.int32(), batch.schema.types[1], pa.int64(), pa.int64()]
            done = []
            for k, o, s in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or k != own:
                    packer, own = Packer(max_items, max_size), k
                if packer.add(s):
                    if now:
                        done.append(now)
                    now = (k, packer.pack, o, 1, s)
                else:
                    now = (*now[:3], packer.items, packer.size)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 5, types)], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(now, types)], names=names)

    sorted_ = rows.repartition(key).sortWithinPartitions(key, "o")
    return sorted_.mapInArrow(fold, f"{key} {kinds[key]}, chunk int, first {kinds['o']}, n bigint, size bigint")


class ChunkTable:
    """The table function of :func:`bounded_chunks`: the chunks of one partition's rows as they come in order.

    rows: a table whose first column names the file, with the columns ``position`` and ``size``, PARTITION BY the file and ORDER BY
    the position. eval sees one row at a time.
    """

    def __init__(self) -> None:
        self.packer: Packer | None = None
        self.now: tuple | None = None

    @staticmethod
    def analyze(rows: AnalyzeArgument, max_items: AnalyzeArgument, max_size: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not {"position", "size"} <= {f.name for f in rows.dataType}:
            raise ValueError("the first argument is a table with the columns position and size")
        first, position = rows.dataType[0], rows.dataType["position"]
        return AnalyzeResult(T.StructType([T.StructField(first.name, first.dataType), T.StructField("chunk", T.IntegerType()), T.StructField("first", position.dataType), T.StructField("n", T.LongType()), T.StructField("size", T.LongType())]))

    def eval(self, rows: Row, max_items: int, max_size: int) -> Iterator[tuple]:
        if self.packer is None:
            self.packer = Packer(max_items, max_size)
        if self.packer.add(rows["size"]):
            if self.now:
                yield self.now
            self.now = (rows[0], self.packer.pack, rows["position"], 1, rows["size"])
        else:
            self.now = (*self.now[:3], self.packer.items, self.packer.size)

    def terminate(self) -> Iterator[tuple]:
        if self.now:
            yield self.now


def register_chunks(spark: SparkSession, name: str = "bounded_chunks") -> None:
    """Makes :class:`ChunkTable` callable from SQL: SELECT * FROM name(max_items => 20, max_size => 1000,
    rows => TABLE(t) PARTITION BY file ORDER BY position)."""
    spark.udtf.register(name, F.udtf(ChunkTable))
