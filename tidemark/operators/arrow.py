"""Arrow batches inside tasks: rows of one key at a time, number lists as matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.sources.durable import spread

Batches = Iterator[pa.RecordBatch]


def by_key(batches: Batches, name: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each whole-number key, where the rows come sorted by key; one key is held at a time."""
    key, held = None, []
    for batch in batches:
        keys = np.asarray(batch.column(name))
        cut = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(cut, cut[1:]):
            if held and keys[a] != key:
                yield int(key), pa.Table.from_batches(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield int(key), pa.Table.from_batches(held)


#: Rows of a batch that goes back to Spark, and of the groups of small keys that are worked on together.
ROWS = 1 << 14


def gathered(batches: Batches) -> Batches:
    """The same rows in batches of about ROWS, as a batch costs as much as hundreds of rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def whole_keys(batches: Batches, name: str) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """(where each key's rows start, and the end; rows) of several whole keys at a time, where the rows come sorted by key."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < ROWS:
            continue
        rows = pa.Table.from_batches(held)
        keys = np.asarray(rows[name])
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        if starts[-1]:  # the last key may go on
            yield starts, rows.slice(0, starts[-1]).combine_chunks()
        held, n = rows.slice(starts[-1]).to_batches(), n - int(starts[-1])
    if n:
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = np.asarray(rows[name])
        yield np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)], rows


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def keyed(df: DataFrame, key: str, run: Callable[[int, pa.Table], Iterator[pa.RecordBatch]], schema: str, *order: str, even: bool = False) -> DataFrame:
    """run(key, rows) for every key, whose rows one task holds in the given order; unlike a group, keys share a task's batches.

    even: keys cost more than their rows' size tells, so the number of tasks is given and small ones are not joined.
    """

    def each(batches: Batches) -> Batches:
        yield from gathered(out for value, rows in by_key(batches, key) for out in run(value, rows))

    return (spread(df, key) if even else df.repartition(key)).sortWithinPartitions(key, *order).mapInArrow(each, schema)


def keyed_small(df: DataFrame, key: str, run: Callable[[np.ndarray, pa.Table], Iterator[pa.RecordBatch]], schema: str, *order: str) -> DataFrame:
    """:func:`keyed` for many keys of few rows: run(starts, rows) has several whole keys at a time."""

    def each(batches: Batches) -> Batches:
        yield from gathered(out for starts, rows in whole_keys(batches, key) for out in run(starts, rows))

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(each, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
