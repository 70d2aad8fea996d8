"""Positions within documents, packed for shuffles and brought together per document.

A document is named by ``ord`` (its id as a long; null: the largest long) and ``uid`` (a 64-bit
hash of its text). What tasks find of documents is sent to the documents' homes, buckets by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K

U64 = np.uint64
LAST = (1 << 63) - 1
SENT = pa.schema([("home", pa.int32()), ("docs", pa.binary()), ("runs", pa.binary())])
#: Bytes of text for which a bucket or home is worth it: buckets grow in number with the input, not in size.
BUCKET_BYTES = 4 << 20


def order_of(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """The id as a long, null last. Ids are compared as numbers, so columns of other types are refused."""
    kind = docs.schema[doc_id].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"{doc_id} must be of an integer type, not {kind.simpleString()}")
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def planes(x: np.ndarray) -> bytes:
    """32-bit or 64-bit values as planes of 16 bits each, low to high: equal high parts compress away."""
    parts = np.ascontiguousarray(x).view(np.uint16).reshape(len(x), -1)
    return np.ascontiguousarray(parts.T).tobytes()


def unplanes(raw: bytes, kind: type) -> np.ndarray:
    n = np.dtype(kind).itemsize // 2
    return np.ascontiguousarray(np.frombuffer(raw, np.uint16).reshape(n, -1).T).view(kind).ravel()


def numbered(ord_: np.ndarray, uid: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(a table of the documents in runs of rows, the number of each row's document in it)."""
    fresh = np.ones(len(ord_), bool)
    fresh[1:] = (ord_[1:] != ord_[:-1]) | (uid[1:] != uid[:-1])
    return ord_[fresh].tobytes() + uid[fresh].tobytes(), (np.cumsum(fresh) - 1).astype(np.int32)


def pack(ord_: np.ndarray, uid: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes]:
    """Positions sorted by document as one table of documents and one of runs (document, first, length)."""
    doc = np.ones(len(ord_), bool)
    doc[1:] = (ord_[1:] != ord_[:-1]) | (uid[1:] != uid[:-1])
    run = doc.copy()
    run[1:] |= pos[1:] != pos[:-1] + 1
    first = np.flatnonzero(run)
    table = np.stack([(np.cumsum(doc) - 1)[first], pos[first], np.diff(np.append(first, len(pos)))]).astype(np.int32)
    return planes(ord_[doc]) + uid[doc].tobytes(), planes(table[0]) + planes(table[1]) + planes(table[2])


def unpack_runs(docs: bytes, runs: bytes) -> tuple[np.ndarray, ...]:
    """(ord, uid) of the documents, and the runs (document, first, length)."""
    n, k = len(docs) // 16, len(runs) // 3
    return unplanes(docs[: 8 * n], np.int64), np.frombuffer(docs[8 * n :], np.int64), *(unplanes(runs[i * k : (i + 1) * k], np.int32) for i in range(3))


def unpack(docs: bytes, runs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ord, uid and position, one entry per position."""
    ord_, uid, doc, first, length = unpack_runs(docs, runs)
    each = np.repeat(doc, length)
    return ord_[each], uid[each], np.repeat(first - (np.cumsum(length) - length), length).astype(np.int32) + np.arange(len(each), dtype=np.int32)


def sent_home(ord_: np.ndarray, uid: np.ndarray, pos: np.ndarray, n: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Positions, packed per home bucket."""
    home = (K.mix(ord_.view(U64) ^ K.mix(uid.view(U64))) >> U64(33)).astype(np.int64) % n
    order = np.lexsort((pos, uid, ord_, home))
    which, first = np.unique(home[order], return_index=True)
    for w, a, b in zip(which, first, np.append(first[1:], len(order))):
        i = order[a:b]
        yield int(w), *pack(ord_[i], uid[i], pos[i])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in K.by_key(batches, "home"):
        held = []
        for docs, runs in zip(K.column(rows, "docs").to_pylist(), K.column(rows, "runs").to_pylist()):
            ord_, uid, doc, first, length = unpack_runs(docs, runs)
            held.append((ord_[doc], uid[doc], first, first + length))
        ord_, uid, first, last = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((first, uid, ord_))
        ord_, uid, pairs = ord_[order], uid[order], np.stack([first, last], axis=1)[order].astype(np.int32)
        cut = np.flatnonzero((ord_[1:] != ord_[:-1]) | (uid[1:] != uid[:-1])) + 1
        at, ends = np.concatenate(([0], cut)), np.append(cut, len(ord_))
        for k in range(0, len(at), 1000):
            a, b = at[k : k + 1000], ends[k : k + 1000]
            yield pa.RecordBatch.from_arrays([pa.array(ord_[a]), pa.array(uid[a]), pa.array([pairs[x:y].tobytes() for x, y in zip(a, b)], pa.binary())], names=["ord", "uid", "runs"])


def gathered(sent: DataFrame) -> DataFrame:
    """One row (ord, uid, runs) per document of what was sent home: int32 pairs (first, one past the last)."""
    return sent.repartition("home").sortWithinPartitions("home").transform(K.mapped, _gathered, "ord long, uid long, runs binary")


def buckets(texts: DataFrame, text: str = "text") -> int:
    """How many buckets a table of texts is dealt to."""
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
