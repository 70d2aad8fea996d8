"""A blocked count-min sketch over window anchors, merged from partition sketches.

A window's anchor is the minimal gram inside it (equal windows have equal anchors), so a window
occurs at most as often as its anchor, and the sketch's estimate for the anchor is an upper bound
of the window's count: a window whose estimate is 1 is certainly unique.

Counters saturate at 2. The cell space is cut into slices by the anchor's high hash bits, each with
``ROWS`` rows; tasks send sorted cell lists per slice, merged in two steps so that no task gathers
from all others at once. The sketch grows with the input and never leaves the executors as a whole:
documents send their anchors to the slices (:func:`repeated`), a task holds one slice at a time,
and what it estimates to repeat comes back as anchor numbers per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored
from tidemark.llm.packed import SENT, gathered, numbered, planes, sent_home, unplanes

U64 = np.uint64
ROWS, ROW_BITS = 2, 19
#: Tasks among which a slice's questions are dealt.
SALTS = 8
SLICE = ROWS << ROW_BITS
#: Anchors that a task holds before it sends them.
FLUSH = 1 << 19
#: (bytes, offsets) of a block -> hash of each anchor, its document, its number within the document; documents ascend.
Anchors = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def place(h: np.ndarray, slices: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The slice of each anchor, and its cell in each row of the slice."""
    h = K.mix(h)  # an anchor is the least hash of many, so its own high bits are nearly always low
    low = U64((1 << ROW_BITS) - 1)
    at = ((h >> U64(40)) * U64(slices)) >> U64(24)
    return at.astype(np.int64), [((h >> U64(r * ROW_BITS)) & low).astype(np.int64) + (r << ROW_BITS) for r in range(ROWS)]


def _partials(anchors: Anchors, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            at, cells = place(np.concatenate(held), slices)
            held.clear()
            key, n = np.unique(np.concatenate([at * SLICE + c for c in cells]), return_counts=True)
            packed = ((key % SLICE) | ((n > 1).astype(np.int64) << 31)).astype(np.uint32)
            which, first = np.unique(key // SLICE, return_index=True)
            ends = np.append(first[1:], len(key))
            for k in range(0, len(which), 1000):
                part = slice(k, k + 1000)
                yield pa.RecordBatch.from_arrays([pa.array(which[part].astype(np.int32)), pa.array([packed[a:b].tobytes() for a, b in zip(first[part], ends[part])], pa.binary())], names=["slice", "cells"])

        total = 0
        for batch in batches:
            data, offsets, _ = K.buffers(batch.column(0))
            for _, _, d, o in K.blocks(data, offsets):
                held.append(anchors(d, o)[0])
                total += len(held[-1])
                if total > FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _merge(final: bool):
    """Cell lists, sorted by slice, to one list (or, at the end, the bits of the cells with a count of 2) per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in K.by_key(batches, "slice"):
            once, twice = np.zeros(SLICE, bool), np.zeros(SLICE, bool)
            for raw in K.column(rows, "cells"):
                packed = np.frombuffer(raw.as_buffer(), np.uint32)
                cells = (packed & np.uint32(0x7FFFFFFF)).astype(np.int64)
                twice[cells[once[cells] | (packed >> np.uint32(31) == 1)]] = True
                once[cells] = True
            if final:
                blob = np.packbits(twice, bitorder="little").tobytes()
            else:
                cells = np.flatnonzero(once)
                blob = (cells | (twice[cells].astype(np.int64) << 31)).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([blob], pa.binary())], names=["slice", "cells"])

    return run


def build(texts: DataFrame, anchors: Anchors, gap: float) -> tuple[DataFrame, int]:
    """(the merged sketch as rows of slice and bits, its number of slices); texts has one column.

    gap: bytes of text per anchor on average; the rows get about six cells an anchor.
    """
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    slices = max(1, int(-(-6 * size // (gap * (1 << ROW_BITS)))))
    schema = "slice int, cells binary"
    part = texts.transform(K.mapped, _partials(anchors, slices), schema)
    part = part.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("slice", "salt").sortWithinPartitions("slice").select("slice", "cells").transform(K.mapped, _merge(False), schema)
    return stored(part.repartition("slice").sortWithinPartitions("slice").transform(K.mapped, _merge(True), schema), "sketch", wide=True), slices


ASKED = "slice int, docs binary, hashes binary, which binary"


def _asked(anchors: Anchors, slices: int):
    """Anchors by slice: (the documents, hashes, and as planes the document and number of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, ord_, uid, nth = (np.concatenate(x) for x in zip(*held))
            held.clear()
            at = place(h, slices)[0]
            order = np.argsort(at, kind="stable")
            which, first = np.unique(at[order], return_index=True)
            rows = []
            for w, a, b in zip(which, first, np.append(first[1:], len(order))):
                i = order[a:b]
                docs, doc = numbered(ord_[i], uid[i])
                rows.append((int(w), docs, h[i].tobytes(), planes(doc) + planes(nth[i])))
            for k in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1000]), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["slice", "docs", "hashes", "which"])

        total = 0
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            ord_, uid = (np.asarray(K.column(batch, c)) for c in ("ord", "uid"))
            for i, _, d, o in K.blocks(data, offsets):
                h, doc, nth = anchors(d, o)
                held.append((h, ord_[i + doc], uid[i + doc], nth.astype(np.int32)))
                total += len(h)
                if total > FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _estimate(slices: int, homes: int):
    """Rows sorted by slice, its bits first: the anchors with an estimate of 2 or more, packed per home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, own = None, -1
        for batch in batches:
            rows = []
            for at, raw, docs, hashes, which in zip(*(K.column(batch, c) for c in ("slice", "cells", "docs", "hashes", "which"))):
                if raw.is_valid:
                    bits, own = np.frombuffer(raw.as_py(), np.uint8), at.as_py()
                    continue
                assert own == at.as_py(), "a slice without its bits"
                h = np.frombuffer(hashes.as_py(), U64)
                hit = np.ones(len(h), bool)
                for c in place(h, slices)[1]:
                    hit &= (bits[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
                if hit.any():
                    raw, table = which.as_py(), docs.as_py()
                    doc, nth = (unplanes(raw[4 * len(h) * k : 4 * len(h) * (k + 1)], np.int32)[hit] for k in range(2))
                    ord_, uid = (np.frombuffer(table[k * len(table) // 2 : (k + 1) * len(table) // 2], np.int64) for k in range(2))
                    rows += sent_home(ord_[doc], uid[doc], nth, homes)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SENT)], schema=SENT)

    return run


def repeated(texts: DataFrame, sketch: tuple[DataFrame, int], anchors: Anchors, homes: int) -> DataFrame:
    """ord, uid and ``hits``: int32 pairs (first, one past the last) of numbers of anchors that may repeat; texts: ord, uid, text and others."""
    bits, slices = sketch
    asked = texts.select("ord", "uid", "text").transform(K.mapped, _asked(anchors, slices), ASKED)
    none = F.lit(None).cast("binary")
    # a slice that many documents ask for is held by several tasks: its bits are repeated over a salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    held = bits.select("slice", "cells", *(none.alias(c) for c in ("docs", "hashes", "which")), F.lit(0).alias("kind"), salts)
    asking = asked.select("slice", none.alias("cells"), "docs", "hashes", "which", F.lit(1).alias("kind"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    found = held.unionByName(asking).repartition("slice", "salt").sortWithinPartitions("slice", "salt", "kind").drop("kind", "salt").transform(K.mapped, _estimate(slices, homes), "home int, docs binary, runs binary")
    return gathered(found).withColumnRenamed("runs", "hits")


def covered(hits: list[bytes | None], n: np.ndarray) -> np.ndarray:
    """Which of all anchors of consecutive documents, n of each, are among their hits."""
    base = np.concatenate(([0], np.cumsum(n)))
    pairs = [np.frombuffer(x, np.int32).reshape(-1, 2).astype(np.int64) + b for x, b in zip(hits, base.tolist()) if x]
    if not pairs:
        return np.zeros(int(base[-1]), bool)
    both = np.concatenate(pairs)
    return K.cover(both[:, 0], both[:, 1], int(base[-1]))
