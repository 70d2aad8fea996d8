"""NumPy kernels over the raw buffers of Arrow string columns.

Texts are processed as one byte buffer per block of documents, so no Python object is made
for a word, a line or a window. A block holds whole documents only; a document longer than
``BLOCK_BYTES`` is a block of its own.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 18
U64 = np.uint64

#: Odd multipliers of the polynomial hashes (arithmetic modulo 2**64).
BASE_BYTES, BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..base**(n-1) and their inverses modulo 2**64; grown on demand and kept."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())

        def run(b: int) -> np.ndarray:
            out = np.full(size, b, dtype=U64)
            out[0] = 1
            return np.cumprod(out, dtype=U64)

        have = _powers[base] = (run(base), run(pow(base, -1, 1 << 64)))
    return have


Batches = Iterator[pa.RecordBatch]
#: Most bytes of rows that Spark hands to Python at once.
BATCH_BYTES = 4 << 20


def mapped(df: DataFrame, run: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow(run, schema) in batches bounded by bytes.

    Spark takes the bound from the session when the plan is run, so a larger one is lowered there and stays so.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = re.fullmatch(r"(\d+) *([kmgtp]?)i?b?", (df.sparkSession.conf.get(name, None) or "").strip().lower())
    if not have or int(have[1]) << 10 * " kmgtp".index(have[2] or " ") > BATCH_BYTES:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(tidy(run), schema)


def by_key(batches: Batches, name: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each key, where the rows come sorted by key; one key is held at a time."""
    key, held = None, []
    for batch in batches:
        keys = np.asarray(column(batch, name))
        cut = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.zeros(1, np.int64)
        for a, b in zip(cut.tolist(), cut[1:].tolist()):
            if held and keys[a] != key:
                yield int(key), pa.Table.from_batches(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield int(key), pa.Table.from_batches(held)


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, giving free memory back to the system when a task ends: workers outlive tasks and share an executor."""

    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(base, len(values))[0][: len(values)], out=out[1:], dtype=U64)
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    return (prefix[ends] - prefix[starts]) * powers(base, len(prefix))[1][starts]


def rolling_hash(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """One unmixed hash per window of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    p = prefix_hash(values, base)
    return (p[width:] - p[:n]) * powers(base, n)[1][:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in time linear in the input."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    tiles = padded.reshape(-1, width)
    left = np.minimum.accumulate(tiles, axis=1).ravel()
    right = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 entries, is-null) of a string or binary array; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(column.is_null())
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    kind = np.int64 if large else np.int32
    if at is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64), null
    offsets = np.frombuffer(at, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0], null


def blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end document, bytes, offsets) of consecutive whole documents."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of the words of decontamination after lower-casing: digits, a-z, all of UTF-8 beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n + 1 word indices at which documents begin."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = member[data]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    fresh[edge] = True
    last = np.ones(n, dtype=bool)
    last[:-1] = ~inside[1:]
    last[edge[edge > 0] - 1] = True
    starts = np.flatnonzero(inside & fresh)
    return starts, np.flatnonzero(inside & last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_BYTES) -> np.ndarray:
    p = prefix_hash(data.astype(U64) + U64(1), base)
    return mix(range_hash(p, starts, ends, base) ^ ((ends - starts).astype(U64) << U64(48)))


def whole(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of the n - width + 1 windows lie inside one document; offsets: where documents begin."""
    ok = np.ones(max(0, n - width + 1), dtype=bool)
    if len(ok) and width > 1:
        bad = np.zeros(len(ok) + 1, dtype=np.int64)
        inner = offsets[(offsets > 0) & (offsets < n)]
        np.add.at(bad, np.clip(inner - width + 1, 0, len(ok)), 1)
        np.add.at(bad, np.clip(inner, 0, len(ok)), -1)
        ok = np.cumsum(bad[:-1]) == 0
    return ok


def anchors(values: np.ndarray, offsets: np.ndarray, gram: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser of every window of ``width`` values that lies inside a document.

    Returns window starts, the position of each window's minimal gram of ``gram`` values (the
    leftmost of equal ones, so equal windows choose alike), and the hashes of all grams.
    """
    grams = mix(rolling_hash(values, gram, BASE_A))
    if len(values) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    bits = U64(max(24, (len(grams) - 1).bit_length()))  # as many for every block, so that equal windows choose alike
    keyed = (grams & ~((U64(1) << bits) - U64(1))) | np.arange(len(grams), dtype=U64)
    least = sliding_min(keyed, width - gram + 1) & ((U64(1) << bits) - U64(1))
    at = np.flatnonzero(whole(offsets, len(values), width))
    return at, least[at].astype(np.int64), grams


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    step = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in at least one [start, end)."""
    d = np.zeros(n + 1, dtype=np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
