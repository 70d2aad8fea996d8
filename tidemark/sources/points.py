"""A vector table as a sink: tasks stage batches of points behind a port, the driver publishes all of a run or nothing.

Every task attempt stages under a name of its own; its commit message carries the name. Only when all tasks have
ended well are the named stages published; a failed task or job leaves stages that readers never see, and they are discarded.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Points of one request.
BATCH = 256


class PointStore(Protocol):
    """What a vector table offers; a point is a row with its payload."""

    def stage(self, run: str, attempt: str, number: int, points: pa.Table) -> None: ...

    def publish(self, run: str, attempts: list[str]) -> None: ...

    def discard(self, run: str) -> None: ...


class FolderStore:
    """A point store in a folder that the driver and all executors reach (any that pyarrow knows)."""

    def __init__(self, path: str) -> None:
        self.path = path

    def _at(self, *parts: str) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path)
        return system, "/".join((root.rstrip("/"), *parts))

    def stage(self, run: str, attempt: str, number: int, points: pa.Table) -> None:
        system, at = self._at("staged", run, attempt)
        system.create_dir(at)
        with system.open_output_stream(f"{at}/{number:06d}.parquet") as out:
            pq.write_table(points, out)

    def publish(self, run: str, attempts: list[str]) -> None:
        system, gathered = self._at("staged", run, ".published")
        system.create_dir(gathered)
        for attempt in attempts:
            system.move(self._at("staged", run, attempt)[1], f"{gathered}/{attempt}")
        system.create_dir(self._at("points")[1])
        system.move(gathered, self._at("points", run)[1])  # one rename makes all visible
        self.discard(run)

    def discard(self, run: str) -> None:
        system, at = self._at("staged", run)
        if system.get_file_info(at).type != fs.FileType.NotFound:
            system.delete_dir(at)


@dataclass
class Staged(WriterCommitMessage):
    """One task's stage, empty if it had no point."""

    attempt: str
    points: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: PointStore, batch: int) -> None:
        self.store, self.batch, self.run = store, batch, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        attempt, number, total, held = uuid.uuid4().hex, 0, 0, []
        for rows in iterator:
            held.append(rows)
            while sum(x.num_rows for x in held) >= self.batch:
                table = pa.Table.from_batches(held)
                self.store.stage(self.run, attempt, number, table.slice(0, self.batch))
                number, total, held = number + 1, total + self.batch, table.slice(self.batch).to_batches()
        if rest := sum(x.num_rows for x in held):
            self.store.stage(self.run, attempt, number, pa.Table.from_batches(held))
            total += rest
        return Staged(attempt if total else "", total)

    def commit(self, messages: list[Staged | None]) -> None:
        named = [m.attempt for m in messages if m is not None and m.attempt]
        if named:
            self.store.publish(self.run, named)

    def abort(self, messages: list[Staged | None]) -> None:
        self.store.discard(self.run)


def point_sink(name: str, store: PointStore, batch: int = BATCH) -> type[DataSource]:
    """A sink of points in batches; register it, then ``df.write.format(name).mode("append").save()``."""

    class Points(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            if overwrite:
                raise ValueError("points are upserted, not overwritten: use mode append")
            return _Writer(store, batch)

    return Points


def published(spark: SparkSession, path: str) -> DataFrame:
    """All published rows of a folder store; of several rows of a point the reader takes the one it wants, by version say."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/points")
