"""Substring dedup: repeated word windows found through a count-min prefilter.

A window is ``window`` consecutive words of one document. A word is removed when some window that
covers it has the same words as a window of a document with a smaller doc_id; windows are judged
on the input. Two windows are the same when two polynomial hashes over independent 64-bit word
hashes agree in 96 bits: among 10**13 windows a false match is expected with probability 1e-3.

1. Partition sketches of window anchors are merged (see :mod:`tidemark.llm.sketch`), at every size
   of the input; their estimates are never below the true counts.
2. Only windows estimated to repeat are grouped exactly. A task first groups its own: of equal
   windows only those of its smallest doc_id are shuffled, the others are already decided, so a
   window that a third of all documents share is sent once per task. Buckets of windows grow in
   number with the input, and a task holds one at a time.
3. Decisions come back as runs of window starts per document and meet the texts in one join.

Defined cases: null or empty text has no words; a null doc_id counts as larger than any other, and
equal doc_ids never remove each other; repeated rows get equal results; fewer words than a window:
nothing is removed; a doc_id of another than an integer type is refused with a TypeError; extra
columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm import sketch as S
from tidemark.llm.packed import SENT, buckets, gathered, order_of, pack, sent_home, unpack

U64 = np.uint64
#: Words of the grams from which a window's anchor is chosen.
GRAM = 16
#: Windows that a task holds before it settles what it has.
FLUSH = 1 << 19


def _prepare(data: np.ndarray, offsets: np.ndarray, window: int):
    starts, ends, at = K.words(data, offsets, K.NOT_SPACE)
    h = K.word_hashes(data, starts, ends)
    return starts, ends, h, at, *K.anchors(h, at, min(GRAM, window), window)


def anchor_hashes(window: int) -> S.Anchors:
    def run(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, _, _, at, _, least, grams = _prepare(data, offsets, window)
        where = np.unique(least)
        doc = np.searchsorted(at, where, "right") - 1
        return grams[where], doc, np.arange(len(where)) - np.searchsorted(doc, doc)

    return run


def _least(ha: np.ndarray, hb: np.ndarray, ord_: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the entries by hash, ord, more; whether each, in that order, has a larger ord than its hash's least)."""
    order = np.lexsort((more, ord_, hb, ha))
    a, b, o = ha[order], hb[order], ord_[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(fresh)
    return order, o > o[first][np.cumsum(fresh) - 1]


OUT = pa.schema([("bucket", pa.int32()), ("home", pa.int32()), ("docs", pa.binary()), ("runs", pa.binary()), ("ha", pa.binary()), ("hb", pa.binary())])
DDL = "bucket int, home int, docs binary, runs binary, ha binary, hb binary"


def _candidates(window: int, buckets: int):
    """Windows whose anchors may repeat, dealt to buckets by anchor; of a task's equal windows only those of the least doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            ha, hb, ord_, uid, pos, bucket = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, later = _least(ha, hb, ord_, pos)
            gone = order[later]
            rows = [(h % buckets, h, d, r, None, None) for h, d, r in sent_home(ord_[gone], uid[gone], pos[gone], buckets)]
            keep = order[~later]
            keep = keep[np.lexsort((pos[keep], uid[keep], ord_[keep], bucket[keep]))]
            which, first = np.unique(bucket[keep], return_index=True)
            for w, a, b in zip(which, first, np.append(first[1:], len(keep))):
                i = keep[a:b]
                rows.append((int(w), None, *pack(ord_[i], uid[i], pos[i]), ha[i].tobytes(), hb[i].tobytes()))
            for k in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 500]), OUT)], schema=OUT)

        total = 0
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            ord_, uid = (np.asarray(K.column(batch, c)) for c in ("ord", "uid"))
            hits = K.column(batch, "hits").to_pylist()
            for i, j, d, o in K.blocks(data, offsets):
                starts, ends, h, at, start, least, grams = _prepare(d, o, window)
                if not len(start):
                    continue
                where, back = np.unique(least, return_inverse=True)
                some = S.covered(hits[i:j], np.diff(np.searchsorted(where, at)))[back]
                first = start[some]
                if not len(first):
                    continue
                row = np.searchsorted(at, first, "right") - 1
                ha = K.mix(K.range_hash(K.prefix_hash(h, K.BASE_A), first, first + window, K.BASE_A))
                other = K.word_hashes(d, starts, ends, K.BASE_B)
                hb = K.mix(K.range_hash(K.prefix_hash(other, K.BASE_B), first, first + window, K.BASE_B))
                bucket = ((grams[least[some]] >> U64(7)) % U64(buckets)).astype(np.int32)
                held.append((ha, (hb >> U64(32)).astype(np.uint32), ord_[i + row], uid[i + row], (first - at[row]).astype(np.int32), bucket))
                total += len(first)
                if total > FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _resolve(buckets: int):
    """Exact grouping of each bucket; what was decided before passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in K.by_key(batches, "bucket"):
            done = K.column(rows, "home").is_valid()
            yield from rows.select(SENT.names).filter(done).to_batches()
            rows = rows.filter(pa.compute.invert(done))
            packed = (K.column(rows, c).to_pylist() for c in ("docs", "runs", "ha", "hb"))
            parts = [(np.frombuffer(a, U64), np.frombuffer(b, np.uint32), *unpack(d, r)) for d, r, a, b in zip(*packed)]
            if not parts:
                continue
            ha, hb, ord_, uid, pos = (np.concatenate(x) for x in zip(*parts))
            order, later = _least(ha, hb, ord_, pos)
            gone = order[later]
            found = list(sent_home(ord_[gone], uid[gone], pos[gone], buckets))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), SENT)], schema=SENT)

    return run


def removed_words(docs: DataFrame, *, window: int = 50) -> DataFrame:
    """doc_id, text, and ``runs``: int32 pairs (first, one past the last) of removed windows' starts, null where there are none."""
    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text"), order_of(docs).alias("ord"), F.xxhash64("text").alias("uid"))
    gap = 6.2 * (window - min(GRAM, window) + 2) / 2
    n = buckets(keyed)
    hits = S.repeated(keyed, S.build(keyed.select("text"), anchor_hashes(window), gap), anchor_hashes(window), n)
    source = keyed.join(hits.hint("shuffle_hash"), ["ord", "uid"])
    decided = source.transform(K.mapped, _candidates(window, n), DDL).repartition("bucket").sortWithinPartitions("bucket").transform(K.mapped, _resolve(n), "home int, docs binary, runs binary")
    return keyed.join(gathered(decided).hint("shuffle_hash"), ["ord", "uid"], "left").select("doc_id", "text", "runs")


def _apply(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            pieces = K.column(batch, "runs").to_pylist()
            total, gone, kept = [], [], []
            for i, j, d, o in K.blocks(data, offsets):
                starts, ends, at = K.words(d, o, K.NOT_SPACE)
                keep = np.ones(len(starts), bool)
                for x in range(i, j):
                    n = int(at[x - i + 1] - at[x - i])
                    if pieces[x]:
                        pairs = np.frombuffer(pieces[x], np.int32).reshape(-1, 2).astype(np.int64)
                        keep[at[x - i] : at[x - i + 1]] = ~K.cover(pairs[:, 0], pairs[:, 1] + window - 1, n)
                    total.append(n)
                    gone.append(n - int(keep[at[x - i] : at[x - i + 1]].sum()))
                kept += joined(d, o, starts, ends, at, keep)
            yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def joined(d: np.ndarray, o: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """The kept words of each document, joined by one space."""
    n = len(d)
    mask = K.cover(starts[keep], ends[keep], n)
    out = d.copy()
    doc = np.searchsorted(at, np.flatnonzero(keep), "right") - 1
    inner = np.ones(len(doc), bool)
    inner[:-1] = doc[1:] == doc[:-1]
    if len(inner):
        inner[-1] = False
    gap = ends[keep][inner]
    out[gap] = 32
    mask[gap] = True
    total = np.concatenate(([0], np.cumsum(mask)))[o]
    raw = out[mask].tobytes()
    return [raw[total[k] : total[k + 1]] for k in range(len(o) - 1)]


def dedup(docs: DataFrame, *, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and ``text`` (the kept words joined by one space)."""
    kind = dict(docs.dtypes)["doc_id"]
    out = removed_words(docs, window=window).transform(K.mapped, _apply(window), f"doc_id {kind}, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op6."""
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
