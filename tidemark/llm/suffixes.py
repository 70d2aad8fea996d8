"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts anywhere else too.

1. Every string of ``length`` bytes has an anchor (its minimal gram of 128 bytes; equal strings
   have equal anchors), and holds the anchor with at least half of what is missing to ``length``
   either before or after it. A count-min sketch (:mod:`tidemark.llm.sketch`) of anchors extended
   to the left, and to the right, drops the strings that are certainly unique.
2. The strings that share one occurrence of an anchor are consecutive; the piece of text that they
   span (at most 2 * length bytes) is sent to its anchor's bucket. Equal pieces within a task are
   settled there and sent once, so a passage that a third of all documents hold is sent once per
   task.
3. Equal pieces settle each other. The different pieces of an anchor are laid over each other at
   the anchor; where their agreement with any other ends, to the left or right, a symbol ends. The
   short symbol strings are suffix-sorted by linear grouping (:mod:`tidemark.llm.suffix_sort`), and
   neighbours in the suffix array give for every place at which an agreement can begin the longest
   one in bytes. A string repeats exactly if such an agreement covers it. Where an anchor has many
   different pieces, those none of whose strings has a twin (by a table of hashes) are sifted out
   before, so a shared passage that is just too short costs no alignment.

The suffix array is built over symbols of agreeing bytes, not over all bytes of the corpus: the
order of Lyndon groups is a sequential computation that Python takes some 4 microseconds a symbol
for, and only pieces of a shared anchor can match at all.

Defined cases: null text is empty; texts are UTF-8 bytes and matches never cross rows; rows that
repeat doc_id and text are different rows and remove each other (if long enough); null doc_ids are
allowed; a doc_id of another than an integer type is refused with a TypeError; extra columns are
ignored; empty table: empty result.
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
from tidemark.llm.packed import SENT, buckets, gathered, order_of, planes, sent_home, unplanes
from tidemark.llm.suffix_sort import common_prefixes, suffix_array

U64 = np.uint64
#: Bytes of the grams from which anchors are chosen.
GRAM = 128
#: Different pieces of one anchor from which on those without a twin are sifted out first, by a table of so many bits.
MANY, TWIN_BITS = 64, 24
#: Bytes of pieces that a task gathers before it settles what it has.
FLUSH = 6 << 20


def _prepare(data: np.ndarray, offsets: np.ndarray, length: int):
    values = data.astype(U64) + U64(1)
    return values, *K.anchors(values, offsets, min(GRAM, length), length)


def _extended(values: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of each anchor with the text before it and with the text after it, and whether its document has as much."""
    gram = min(GRAM, length)
    more = (length - gram) // 2
    prefix = K.prefix_hash(values, K.BASE_A)
    doc = np.searchsorted(offsets, at, "right") - 1
    hashes, there = [], []
    for first in (at - more, at):
        last = first + gram + more
        there.append((first >= offsets[doc]) & (last <= offsets[doc + 1]))
        hashes.append(K.mix(K.range_hash(prefix, np.where(there[-1], first, 0), np.where(there[-1], last, 0), K.BASE_A)))
    return hashes, there


def anchor_hashes(length: int) -> S.Anchors:
    """Anchors extended to the left have even numbers in their document, those extended to the right odd ones."""

    def run(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, start, least, _ = _prepare(data, offsets, length)
        head = np.flatnonzero(np.diff(least, prepend=-1))
        hashes, there = _extended(values, offsets, least[head], length)
        doc = np.searchsorted(offsets, start[head], "right") - 1
        nth = np.arange(len(head)) - np.searchsorted(doc, doc)
        h, doc, nth, ok = (np.stack(x, axis=1).ravel() for x in (hashes, (doc, doc), (2 * nth, 2 * nth + 1), there))
        return h[ok], doc[ok], nth[ok]

    return run


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... count times, for each."""
    return np.repeat(first - (np.cumsum(count) - count), count).astype(np.int32) + np.arange(int(count.sum()), dtype=np.int32)


def _settled(ord_: np.ndarray, uid: np.ndarray, pos: np.ndarray, count: np.ndarray, homes: int) -> Iterator[tuple[int, bytes, bytes]]:
    if len(ord_):
        yield from sent_home(np.repeat(ord_, count), np.repeat(uid, count), _spread(pos, count), homes)


OUT = pa.schema([("bucket", pa.int32()), ("home", pa.int32()), ("docs", pa.binary()), ("runs", pa.binary()), ("hashes", pa.binary()), ("meta", pa.binary()), ("bytes", pa.binary())])
DDL = "bucket int, home int, docs binary, runs binary, hashes binary, meta binary, bytes binary"


def _equal(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by the rows of hashes, number of the group of equal rows in that order)."""
    order = np.lexsort((hashes[:, 2], hashes[:, 1], hashes[:, 0]))
    h = hashes[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]).any(axis=1)
    return order, np.cumsum(fresh) - 1


def _pieces(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            hashes, meta, keys = (np.concatenate([x[k] for x in held]) for k in range(3))
            raw = b"".join(x[3] for x in held)
            held.clear()
            size = meta[:, 1] + length - 1
            at = np.cumsum(size) - size
            order, group = _equal(hashes)
            times = np.bincount(group)[group]
            lead = np.ones(len(order), bool)
            lead[1:] = group[1:] != group[:-1]
            same = order[times > 1]
            rows = [(w, w, d, r, None, None, None) for w, d, r in _settled(keys[same, 0], keys[same, 1], meta[same, 2].astype(np.int32), meta[same, 1], buckets)]
            keep, several = order[lead], times[lead] > 1
            bucket = ((hashes[keep, 0] >> U64(7)) % U64(buckets)).astype(np.int32)
            by = np.lexsort((hashes[keep, 0], bucket))  # pieces of one anchor side by side, so they compress well
            which, first = np.unique(bucket[by], return_index=True)
            for w, a, b in zip(which, first, np.append(first[1:], len(by))):
                i = keep[by[a:b]]
                numbers = b"".join(planes(x) for x in (*meta[i].T.astype(np.int32), several[by[a:b]].astype(np.int32), keys[i, 0], keys[i, 1]))
                rows.append((int(w), None, None, None, hashes[i].tobytes(), numbers, pa.compress(b"".join([raw[x : x + y] for x, y in zip(at[i].tolist(), size[i].tolist())]), codec="zstd", asbytes=True)))
            for k in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 500]), OUT)], schema=OUT)

        total = 0
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            ord_, uid = (np.asarray(K.column(batch, c)) for c in ("ord", "uid"))
            hits = K.column(batch, "hits").to_pylist()
            for i, j, d, o in K.blocks(data, offsets):
                if len(d) < length:
                    continue
                values, start, least, grams = _prepare(d, o, length)
                head = np.flatnonzero(np.diff(least, prepend=-1))  # where another occurrence of an anchor takes over
                if not len(head):
                    continue
                count = np.diff(np.append(head, len(least)))
                doc = np.searchsorted(o, start[head], "right") - 1
                anchor, first = least[head], start[head]
                gram, more = min(GRAM, length), (length - min(GRAM, length)) // 2
                _, there = _extended(values, o, anchor, length)
                number = np.searchsorted(doc, np.arange(j - i + 1))
                maybe = S.covered(hits[i:j], 2 * np.diff(number)).reshape(-1, 2)
                before, after = there[0] & maybe[:, 0], there[1] & maybe[:, 1]
                last = first + count  # one past the last start; strings that lack both extensions are unique
                lo = np.where(before, first, np.maximum(first, anchor + gram + more - length))
                hi = np.where(after, last, np.minimum(last, anchor - more + 1))
                some = (before | after) & (lo < hi)
                if not some.any():
                    continue
                head, doc, first, count = head[some], doc[some], lo[some], (hi - lo)[some]
                ends = first + count + length - 1
                hashes = np.stack([grams[least[head]], *(K.mix(K.range_hash(K.prefix_hash(values, b), first, ends, b) ^ count.astype(U64)) for b in (K.BASE_A, K.BASE_B))], axis=1)
                meta = np.stack([least[head] - first, count, first - o[doc]], axis=1)
                keys = np.stack([ord_[i + doc], uid[i + doc]], axis=1)
                raw = d.tobytes()
                held.append((hashes, meta, keys, b"".join([raw[x:y] for x, y in zip(first.tolist(), ends.tolist())])))
                total += len(held[-1][3])
                if total > FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _side(parts: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """Order of the parts, agreement of each with the one before it in that order, and each part's largest agreement."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    near = [0, *(_agree(parts[a], parts[b]) for a, b in zip(order, order[1:]))]
    best = [0] * len(parts)
    for k, i in enumerate(order):
        best[i] = max(near[k], near[k + 1] if k + 1 < len(near) else 0)
    return order, near, best


def _symbols(order: list[int], near: list[int], best: list[int], used: set[int], name: int) -> tuple[list[list[tuple[int, int]]], int]:
    """Per part its (symbol, bytes agreed up to its end), from the anchor outwards."""
    out: list[list[tuple[int, int]]] = [[] for _ in order]
    for level in sorted({x for x in near if x > 0}):
        name += 1
        for k, i in enumerate(order):
            if near[k] < level:
                name += 1
            if best[i] >= level and i in used:
                out[i].append((name, level))
    return out, name + 1


def repeats(pieces: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For different pieces (bytes, offset of their common anchor): ranges of starts of strings that some other piece holds too."""
    found: list[list[tuple[int, int]]] = [[] for _ in pieces]
    right = _side([p[a:] for p, a in pieces])
    left = _side([p[:a][::-1] for p, a in pieces])
    used = {i for i in range(len(pieces)) if right[2][i] + left[2][i] >= length}
    if len(used) < 2:
        return found
    rights, name = _symbols(*right, used, 2)
    lefts, _ = _symbols(*left, used, name)
    text: list[int] = []
    upto: list[int] = [0]  # bytes of the symbols before each place
    starts: list[tuple[int, int, int]] = []  # place in the text, piece, bytes to the left of the anchor
    for i in sorted(used):
        for k in range(len(lefts[i]) - 1, -1, -1):
            symbol, reach = lefts[i][k]
            starts.append((len(text), i, reach))
            text.append(symbol)
            upto.append(upto[-1] + reach - (lefts[i][k - 1][1] if k else 0))
        starts.append((len(text), i, 0))
        before = 0
        for symbol, reach in rights[i]:
            text.append(symbol)
            upto.append(upto[-1] + reach - before)
            before = reach
        text.append(1)
        upto.append(upto[-1])
    text.append(0)
    upto.append(upto[-1])
    order = suffix_array(text)
    shared = [*common_prefixes(text, order, 1), 0]
    rank = [0] * len(order)
    for k, s in enumerate(order):
        rank[s] = k
    for place, i, reach in starts:
        k = max(shared[rank[place]], shared[rank[place] + 1])
        spare = upto[place + k] - upto[place] - length
        if spare >= 0:
            first = pieces[i][1] - reach
            found[i].append((first, first + spare + 1))
    return found


def _with_twins(raw: bytes, at: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Which of many pieces may hold a string that occurs twice among them: by two passes over all strings' hashes and a table of fixed size."""
    once, twice = np.zeros(1 << TWIN_BITS, bool), np.zeros(1 << TWIN_BITS, bool)

    def cells() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for i in range(0, len(at), 2000):
            offsets = np.concatenate(([0], np.cumsum(size[i : i + 2000])))
            data = np.frombuffer(b"".join([raw[x : x + n] for x, n in zip(at[i : i + 2000].tolist(), size[i : i + 2000].tolist())]), np.uint8)
            h = K.mix(K.rolling_hash(data.astype(U64) + U64(1), length, K.BASE_B)) >> U64(64 - TWIN_BITS)
            where = np.flatnonzero(K.whole(offsets, len(data), length))
            yield i, np.searchsorted(offsets, where, "right") - 1, h[where].astype(np.int64)

    for _, _, c in cells():
        own, n = np.unique(c, return_counts=True)
        twice[own[once[own] | (n > 1)]] = True
        once[own] = True
    may = np.zeros(len(at), bool)
    for i, piece, c in cells():
        may[i + piece[twice[c]]] = True
    return may


def _resolve(length: int, buckets: int):
    """Settles the pieces of each bucket; what was settled before passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in K.by_key(batches, "bucket"):
            done = K.column(rows, "home").is_valid()
            yield from rows.select(SENT.names).filter(done).to_batches()
            found = _bucket(rows.filter(pa.compute.invert(done)), length, buckets)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), SENT)], schema=SENT)

    return run


def _bucket(rows: pa.Table, length: int, homes: int) -> list[tuple[int, bytes, bytes]]:
    parts, blobs = [], []
    for h, m, raw in zip(*(K.column(rows, c).to_pylist() for c in ("hashes", "meta", "bytes"))):
        hashes = np.frombuffer(h, U64).reshape(-1, 3)
        n = len(hashes)
        ints = [unplanes(m[4 * n * k : 4 * n * (k + 1)], np.int32) for k in range(4)]
        parts.append((hashes, np.stack(ints, axis=1), unplanes(m[16 * n : 24 * n], np.int64), unplanes(m[24 * n :], np.int64)))
        blobs.append(pa.decompress(raw, decompressed_size=int(ints[1].sum()) + n * (length - 1), codec="zstd", asbytes=True))
    if not parts:
        return []
    hashes, meta, ord_, uid = (np.concatenate([p[k] for p in parts]) for k in range(4))
    size = meta[:, 1].astype(np.int64) + length - 1
    at = np.cumsum(size) - size
    raw = b"".join(blobs)
    order, group = _equal(hashes)
    times = np.bincount(group, 1 + meta[order, 3])[group]
    lead = np.ones(len(order), bool)
    lead[1:] = group[1:] != group[:-1]
    # whole pieces that occur twice or more
    gone = order[(times > 1) & (meta[order, 3] == 0)]
    out = list(_settled(ord_[gone], uid[gone], meta[gone, 2], meta[gone, 1], homes))
    # anchors with different pieces of which some occur once
    reps, once = order[lead], times[lead] < 2
    anchor = hashes[reps, 0]
    cut = np.union1d(np.flatnonzero(np.diff(anchor.view(np.int64), prepend=0) != 0), [0])
    several = np.diff(np.append(cut, len(anchor)))
    open_ = np.logical_or.reduceat(once, cut) & (several > 1)
    hits: list[tuple[int, int, int]] = []
    for a, n in zip(cut[open_].tolist(), several[open_].tolist()):
        own, single = reps[a : a + n], once[a : a + n]
        if n > MANY:
            may = _with_twins(raw, at[own], size[own], length)
            own, single = own[may], single[may]
        pieces = [(raw[at[x] : at[x] + size[x]], int(meta[x, 0])) for x in own]
        for k, ranges in enumerate(repeats(pieces, length)):
            if single[k]:
                x = int(own[k])
                hits += [(x, max(lo, 0), min(hi, int(meta[x, 1]))) for lo, hi in ranges if min(hi, int(meta[x, 1])) > max(lo, 0)]
    if hits:
        x, lo, hi = (np.array(c) for c in zip(*hits))
        out += list(_settled(ord_[x], uid[x], (meta[x, 2] + lo).astype(np.int32), hi - lo, homes))
    return out


def _apply(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            total, gone, spans, kept = [], [], [], []
            for x, runs in enumerate(K.column(batch, "runs").to_pylist()):
                own = data[offsets[x] : offsets[x + 1]]
                total.append(len(own))
                if runs:
                    pairs = np.frombuffer(runs, np.int32).reshape(-1, 2).astype(np.int64)
                    mask = K.cover(pairs[:, 0], pairs[:, 1] + length - 1, len(own))
                    gone.append(int(mask.sum()))
                    spans.append(np.stack(K.runs(mask), axis=1).tolist())
                    own = own[~mask]
                else:
                    gone.append(0)
                    spans.append([])
                kept.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return run


def dedup(docs: DataFrame, *, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, ``spans`` (removed byte ranges) and ``kept`` (the remaining bytes)."""
    kind = dict(docs.dtypes)["doc_id"]
    text = F.col("text").cast("string")
    keyed = docs.select("doc_id", text.cast("binary").alias("text"), order_of(docs).alias("ord"), F.xxhash64(text).alias("uid"))
    n = buckets(keyed)
    sketch = S.build(keyed.select("text"), anchor_hashes(length), (length - min(GRAM, length) + 2) / 4)
    hits = S.repeated(keyed, sketch, anchor_hashes(length), n)
    source = keyed.join(hits.hint("shuffle_hash"), ["ord", "uid"])
    decided = source.transform(K.mapped, _pieces(length, n), DDL).repartition("bucket").sortWithinPartitions("bucket").transform(K.mapped, _resolve(length, n), "home int, docs binary, runs binary")
    joined = keyed.join(gathered(decided).hint("shuffle_hash"), ["ord", "uid"], "left").select("doc_id", "text", "runs")
    return joined.transform(K.mapped, _apply(length), f"doc_id {kind}, n_bytes long, n_removed long, spans array<array<long>>, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op7."""
    found = dedup(docs)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
