"""Benchmark decontamination by a prefix-filtered containment join.

A window is ``window`` consecutive words of a benchmark item (an item of fewer words, but not
none, is one window). A window is contained in a document when its words occur there in a row.

1. Each window is a set of word shingles. One pass over all documents counts every benchmark
   shingle in the whole corpus; tasks add up first, a shuffle sums the counts of partitions.
2. Shingles are ordered by rarity (count, then hash). Containment demands every shingle, so the
   necessary prefix of a window is its single rarest one; a window with a shingle that no document
   holds is dropped.
3. A second pass joins document shingles with the prefixes by a shuffle. The shingle's offset in the
   window gives the only possible start (positional bound); the window must fit in the document
   (length bound).
4. Survivors are verified byte for byte over the window, from the words around the shingle that come
   with it. What is found meets the documents by two independent 64-bit hashes of their text.

The benchmark is never collected: documents are scanned as often for a large one as for a small
one. Before a shuffle, bitmaps of at most ``1 << MAX_BITS`` bits sieve document shingles; where they
are too small for a large benchmark, more passes them, and the joins decide.

Defined cases: a null or wordless document has no words and is never contaminated; a null or
wordless item has no windows; repeated documents are judged alike; repeated items count one by one
under their own ids, and a repeated item_id counts once; null item_ids are left out of the id list
but their windows hit. Extra columns pass through; a column that has the name of an added one is
replaced, and names that begin with ``_tm_`` are reserved. An empty table gives an empty result; an
empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored

U64 = np.uint64
#: Words in the shingles that are counted and joined; shorter windows use their whole length.
SHINGLE = 5
#: Logarithm of the most bits in a sieve, 4 MB; below that so many bits a shingle, one of which lets a thousandth of other shingles pass.
MAX_BITS, SPARSE = 25, 1000
#: Bytes of findings up to which they are sent to the documents; beyond, both are shuffled.
SENT_BYTES = 4 << 20
#: Different shingles that a task adds up before it sends their counts.
FLUSH = 1 << 19


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, at = K.words(data, offsets, K.ALNUM)
    return starts, ends, at, K.word_hashes(data, starts, ends)


def _grams(h: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of its first word, hash) of every shingle of ``size`` words inside a document."""
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    ok = np.flatnonzero(K.whole(at, len(h), size))
    return ok, K.mix(K.rolling_hash(h, size, K.BASE_A)[ok] ^ U64(size))


def _windows(window: int):
    """Item, size, hash, words and shingles of every window of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "t"))
            for i, j, d, o in K.blocks(K.LOWER[data], offsets):
                starts, ends, at, h = _words(d, o)
                raw = d.tobytes()
                words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                gram = {n: _grams(h, at, n) for n in range(1, SHINGLE + 1)}
                rows = []
                for x in range(j - i):
                    first, n = int(at[x]), int(at[x + 1] - at[x])
                    size = min(window, n)
                    for k in range(first, first + n - size + 1) if n else ():
                        g = min(size, SHINGLE)
                        place, own = gram[g]
                        lo = int(np.searchsorted(place, k))
                        rows.append((i + x, size, b" ".join(words[k : k + size]), own[lo : lo + size - g + 1].view(np.int64).tolist()))
                for k in range(0, len(rows), 2000):
                    at_, size, text, grams = zip(*rows[k : k + 2000])
                    yield pa.RecordBatch.from_arrays([K.column(batch, "item").take(pa.array(at_)), pa.array(size, pa.int32()), pa.array(text, pa.binary()), pa.array(grams, pa.list_(pa.int64()))], names=["item", "size", "words", "grams"])

    return run


def _sieve(grams: DataFrame) -> Broadcast:
    """A bitmap of the values of the only column, of bounded size."""
    bits = min(MAX_BITS, max(16, (grams.count() * SPARSE).bit_length()))
    name = F.col(grams.columns[0])
    low = name.bitwiseAND((1 << bits) - 1)
    marks = grams.groupBy(F.shiftright(low, 3).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1, cast({grams.columns[0]} & 7 as int))")).alias("mark")).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[np.asarray(marks.column("at"))] = np.asarray(marks.column("mark")).astype(np.uint8)
    return grams.sparkSession.sparkContext.broadcast(out)


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = (h & U64(len(bits) * 8 - 1)).astype(np.int64)
    return np.flatnonzero((bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1)


def _count(sizes: list[int], sieve: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, n = (np.concatenate(x) for x in zip(*held))
            held.clear()
            gram, at = np.unique(h, return_inverse=True)
            for k in range(0, len(gram), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(gram[k : k + 100_000].view(np.int64)), pa.array(np.bincount(at, n)[k : k + 100_000].astype(np.int64))], names=["gram", "n"])

        total = 0
        for batch in batches:
            data, offsets, _ = K.buffers(batch.column(0))
            for _, _, d, o in K.blocks(K.LOWER[data], offsets):
                _, _, at, h = _words(d, o)
                for size in sizes:
                    grams = _grams(h, at, size)[1]
                    held.append(np.unique(grams[_passes(sieve.value, grams)], return_counts=True))
                    total += len(held[-1][0])
            if total > FLUSH:
                yield from flush()
                total = 0
        if held:
            yield from flush()

    return run


KEYS = ("_tm_uid", "_tm_uid2")
MET = "gram long, uid long, uid2 long, pos int, before int, around binary"


def _met(sizes: list[int], sieve: Broadcast, window: int):
    """Document shingles that may be prefixes, with the words around them; documents with the same text of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "t"))
            uid, uid2 = (np.asarray(K.column(batch, c)) for c in ("uid", "uid2"))
            lead = np.zeros(len(uid), bool)
            lead[np.unique(np.stack((uid, uid2), axis=1), axis=0, return_index=True)[1]] = True
            for i, _, d, o in K.blocks(K.LOWER[data], offsets):
                starts, ends, at, h = _words(d, o)
                rows = []
                for size in sizes:
                    place, grams = _grams(h, at, size)
                    hit = _passes(sieve.value, grams)
                    more = window - 1 if size == SHINGLE else 0  # a shorter shingle is a whole window
                    doc = np.searchsorted(at, place[hit], "right") - 1
                    for p, g, x in zip(place[hit].tolist(), grams[hit].view(np.int64).tolist(), doc.tolist()):
                        if lead[i + x]:
                            lo, hi = max(int(at[x]), p - more), min(int(at[x + 1]), p + size + more)
                            rows.append((g, uid[i + x], uid2[i + x], p - int(at[x]), p - lo, b" ".join(d[a:b].tobytes() for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist()))))
                for k in range(0, len(rows), 5000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 5000]), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["gram", "uid", "uid2", "pos", "before", "around"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of shingles met with a prefix, those around which the whole window stands: where it starts."""
    for batch in batches:
        ok, first = [], []
        for pos, before, around, offset, size, words in zip(*(K.column(batch, c).to_pylist() for c in ("pos", "before", "around", "offset", "size", "words"))):
            at = before - offset
            first.append(pos - offset)
            ok.append(at >= 0 and b" ".join(around.split(b" ")[at : at + size]) == words)
        some = pa.array(ok, pa.bool_())
        columns = [K.column(batch, "uid"), K.column(batch, "uid2"), pa.array(first, pa.int32()), K.column(batch, "size"), K.column(batch, "w")]
        yield pa.RecordBatch.from_arrays([c.filter(some) for c in columns], names=["uid", "uid2", "first", "size", "w"])


def _finish(text: str):
    """Counts words and united spans of each document; ``_tm_found`` has its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = dict(zip(batch.schema.names, batch.columns))
            found = arrays.pop("_tm_found").to_pylist()
            items = arrays.pop("_tm_items").to_pylist()
            data, offsets, _ = K.buffers(arrays[text])
            counts = [int(n) for _, _, d, o in K.blocks(K.LOWER[data], offsets) for n in np.diff(K.words(d, o, K.ALNUM)[2])]
            hits, spans = [], []
            for n, own in zip(counts, found):
                mask = np.zeros(n, bool)
                if own:
                    first, size = (np.array([x[c] for x in own], np.int64) for c in ("first", "size"))
                    mask = K.cover(first, first + size, n)
                hits.append(int(mask.sum()))
                spans.append(np.stack(K.runs(mask)).T.tolist())
            arrays |= {"_tm_n_words": pa.array(counts, pa.int64()), "_tm_n_hit": pa.array(hits, pa.int64()), "_tm_hit_spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))), "_tm_hit_items": pa.array([sorted(x or []) for x in items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return run


def occurrences(docs: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """(uid, uid2, first, size, w) for every window that stands in a document; docs: uid, uid2, t; windows: w, size, words, grams."""
    flat = windows.select("w", "size", F.posexplode("grams").alias("offset", "gram"))
    grams = stored(flat.select("gram").distinct(), "grams")
    sizes = sorted({min(r["size"], SHINGLE) for r in windows.select("size").distinct().collect()})  # at most ``window`` rows
    counted = docs.select("t").transform(K.mapped, _count(sizes, _sieve(grams)), "gram long, n long")
    counts = stored(counted.join(grams, "gram", "left_semi").groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    rated = flat.join(counts, "gram", "left").groupBy("w").agg(F.min(F.coalesce("n", F.lit(0))).alias("least"), F.min(F.struct("n", "gram", "offset")).alias("p"))
    prefixes = rated.where("least > 0").select("w", F.col("p.gram").alias("gram"), F.col("p.offset").alias("offset"))
    prefixes = stored(prefixes.join(windows.select("w", "size", "words"), "w"), "prefixes")
    met = docs.transform(K.mapped, _met(sizes, _sieve(prefixes.select("gram").distinct()), window), MET)
    both = met.join(prefixes, "gram").select("uid", "uid2", "pos", "before", "around", "offset", "size", "words", "w")
    return both.transform(K.mapped, _verify, "uid long, uid2 long, first int, size int, w long")


def text_keys(text: Column) -> tuple[Column, Column]:
    """By what a text's findings come back to it: two hashes with different seeds."""
    return F.xxhash64(text), F.xxhash64(F.lit(2), text)


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13) -> DataFrame:
    """docs with ``n_words``, ``n_hit``, ``hit_spans`` (word ranges), ``hit_items`` (sorted id strings)."""
    added = ("n_words", "n_hit", "hit_spans", "hit_items")
    out = docs.drop(*(c for c in added if c != text))
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("t"))
    parts = items.transform(K.mapped, _windows(window), "item string, size int, words binary, grams array<long>")
    parts = stored(parts.withColumn("w", F.xxhash64("words")).distinct(), "windows")
    windows = stored(parts.select("w", "size", "words", "grams").dropDuplicates(["words"]), "distinct")
    plain = F.col(text).cast("string")
    found = stored(occurrences(docs.select(*(k.alias(c) for k, c in zip(text_keys(plain), ("uid", "uid2"))), plain.alias("t")), windows, window).distinct(), "occurrences")
    spans = found.groupBy("uid", "uid2").agg(F.collect_set(F.struct("first", "size")).alias("_tm_found"))
    named = found.select("uid", "uid2", "w").distinct().join(parts.where("item is not null").select("w", "item").distinct(), "w").groupBy("uid", "uid2").agg(F.collect_set("item").alias("_tm_items"))
    hits = stored(spans.join(named, ["uid", "uid2"], "left").withColumnsRenamed({"uid": "_tm_uid", "uid2": "_tm_uid2"}), "hits")
    size = hits.agg(F.sum(72 + 16 * F.size("_tm_found") + F.coalesce(F.octet_length(F.array_join("_tm_items", ",")), F.lit(0)))).first()[0] or 0
    hits = F.broadcast(hits) if size <= SENT_BYTES else hits.hint("shuffle_hash")
    joined = out.withColumns(dict(zip(KEYS, text_keys(plain)))).join(hits, list(KEYS), "left").drop(*KEYS)
    done = T.StructType([*out.schema.fields, T.StructField("_tm_n_words", T.LongType()), T.StructField("_tm_n_hit", T.LongType()), T.StructField("_tm_hit_spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("_tm_hit_items", T.ArrayType(T.StringType()))])
    result = joined.transform(K.mapped, _finish(text), done)
    return result.withColumnsRenamed({f"_tm_{c}": c for c in added})


def is_contaminated() -> "F.Column":
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of query op2: one row per document."""
    found = contamination(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )
