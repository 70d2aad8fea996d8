"""Positional scans planned from a Parquet footer: a task for each row group that overlaps the asked rows, no other is opened."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StructField, StructType


def _opened(path: str) -> pq.ParquetFile:
    system, at = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(system.open_input_file(at))


@dataclass
class RowGroup(InputPartition):
    """A row group by number, the stored position of its first row, and the rows that are asked for."""

    number: int
    first: int
    start: int
    end: int


def overlapping(metadata: pq.FileMetaData, start: int, end: int) -> list[RowGroup]:
    """The row groups that hold a row of [start, end)."""
    out, first = [], 0
    for k in range(metadata.num_row_groups):
        n = metadata.row_group(k).num_rows
        if first < end and first + n > start:
            out.append(RowGroup(k, first, max(start, first), min(end, first + n)))
        first += n
    return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        self.path, self.start, self.end, self.columns = options["path"], int(options["start"]), int(options["end"]), columns

    def partitions(self) -> list[InputPartition]:
        return overlapping(_opened(self.path).metadata, self.start, self.end) or [RowGroup(-1, 0, 0, 0)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        if partition.number < 0:
            return
        at = partition.first
        for batch in _opened(self.path).iter_batches(row_groups=[partition.number], columns=self.columns):
            lo, hi = max(partition.start - at, 0), min(partition.end - at, batch.num_rows)
            if lo < hi:
                number = pa.array(range(at + lo, at + hi), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, number], names=[*self.columns, "row_number"])
            at += batch.num_rows


class RowRange(DataSource):
    """Options: path of one file, start, end (excluded), columns (comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_row_range"

    def schema(self) -> StructType:
        raise NotImplementedError("row_range() passes the file's schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), [f.name for f in schema if f.name != "row_number"])


def row_range(spark: SparkSession, path: str, start: int, end: int, columns: list[str] | None = None) -> DataFrame:
    """Rows [start, end) of one file by their stored position in ``row_number``; the driver reads the footer, tasks the row groups that overlap."""
    own = spark.read.parquet(path).select(*(columns or ["*"])).schema
    spark.dataSource.register(RowRange)
    schema = StructType([*own, StructField("row_number", LongType())])
    rows = spark.read.format("tidemark_row_range").schema(schema).option("path", path).option("start", start).option("end", end).load()
    return rows.where(F.col("row_number").between(start, end - 1))
