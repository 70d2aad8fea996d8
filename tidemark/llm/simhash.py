"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: texts are lower-cased (A-Z), split into words, and cut into ``shingle``-word shingles
joined by one space, repeats included (fewer words: the whole sequence; none: fingerprint zero).
A bit is set if it is set in over half the XXH64 hashes (UTF-8, seed 42) of the shingles.

Links: two fingerprints link at ``radius`` = 4 or fewer differing bits. Emitting the full ball of
half the radius takes 2,081 variants a fingerprint; instead the 64 bits are cut into three blocks.
Of 4 differing bits some two blocks together hold at most 2, so for each of the three pairs of
blocks a fingerprint emits all variants of those 42 or 43 bits within half of that, which is 1:
131 variants in all. Fingerprints that share a variant meet in the middle; they are verified over
all 64 bits. No pair within radius 4 is lost and the keys keep 42 bits.

Equal fingerprints are one node, so a group of exact copies costs one ball. A task verifies the
groups of its partition and keeps only a spanning forest of what it found, so a large group yields
as many edges as it has members. Components are settled by :mod:`tidemark.llm.components`, which raises a
RuntimeError after 50 rounds. A very long text takes about 100 bytes of memory a byte in one task.

Defined cases: null and empty texts have fingerprint zero and link with each other; repeated rows
and equal doc_ids share a component; a null doc_id belongs to its fingerprint's component but never
names it (a component of null ids only has a null id); extra columns are ignored by
:func:`classes` and kept by :func:`keep_one`, where names that begin with ``_tm_`` are reserved;
empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm.components import components
from tidemark.llm.durable import stored

U64 = np.uint64
RADIUS = 4
#: The three blocks as bit masks, and the three pairs of blocks that serve as keys.
BLOCKS = ((1 << 22) - 1, ((1 << 21) - 1) << 22, ((1 << 21) - 1) << 43)
PAIRS = tuple(BLOCKS[a] | BLOCKS[b] for a, b in ((0, 1), (0, 2), (1, 2)))
#: Least fingerprints for which a task of its own is worth it; keeps buckets times tasks in proportion to the input.
TASK = 5000
#: Variants in a bucket, about.
BUCKET = 1 << 18
#: Groups up to this size are compared pair by pair; larger ones grow spanning trees.
SMALL = 6


def fingerprint(text: bytes, shingle: int) -> int:
    parts = text.lower().split()
    if not parts:
        return 0
    raw = b" ".join(parts)
    if len(parts) <= shingle:
        h = xxhash.xxh64_digest(raw, 42)
        return int.from_bytes(h, "big")
    gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    starts = [0, *(gaps[: len(parts) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(raw)]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(raw[s:e], 42) for s, e in zip(starts, ends)]), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[k : k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _print(text: str, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, text))
            raw, at = memoryview(np.ascontiguousarray(data)), offsets.tolist()
            found = np.array([fingerprint(bytes(raw[a:b]), shingle) for a, b in zip(at, at[1:])], dtype=U64)
            arrays = dict(zip(batch.schema.names, batch.columns)) | {"fp": pa.array(found.view(np.int64))}
            arrays.pop(text)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return run


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, uid (a hash of the text) and ``fp`` (the fingerprint's bits as a long)."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("uid"), F.col("text").cast("string").alias("text")).transform(K.mapped, _print("text", shingle), f"doc_id {kind}, uid long, fp long")


def _ball(buckets: int):
    """Each fingerprint's variants, dealt out to buckets: (bucket, fingerprints, flipped bits)."""
    flips = [np.array([0, *(1 << b for b in range(64) if m >> b & 1)], dtype=U64) for m in PAIRS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything = np.asarray(K.column(batch, "fp")).view(U64)
            for k in range(0, len(everything), 1 << 14):
                fp = everything[k : k + (1 << 14)]
                for c, (m, flip) in enumerate(zip(PAIRS, flips)):
                    variant = ((fp & U64(m))[:, None] ^ flip[None, :]).ravel()
                    bucket = (K.mix(variant) >> U64(33)).astype(np.int64) % buckets * len(PAIRS) + c
                    order = np.argsort(bucket, kind="stable")
                    which, first = np.unique(bucket[order], return_index=True)
                    owner, bit = (order // len(flip)), (order % len(flip)).astype(np.uint8)
                    prints, ends = fp[owner], np.append(first[1:], len(order))
                    yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array([prints[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()), pa.array([bit[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["bucket", "fps", "bits"])

    return run


class Forest:
    """Union-find over fingerprints; the root of a tree is its least member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (parent := self.up.get(root, root)) != root:
            root = parent
        while (parent := self.up.get(x, x)) != root:
            self.up[x], x = root, parent
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _trees(own: np.ndarray, forest: Forest) -> None:
    """Joins what lies within the radius in one large group, ending once every member has been reached."""
    own = np.unique(own)
    left = own
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            x, front = front[0], front[1:]
            near = np.bitwise_count(left ^ x) <= RADIUS
            for y in left[near].tolist():
                forest.join(int(x), y)
            front, left = np.concatenate((front, left[near])), left[~near]


#: Linked fingerprints that a task's forest holds at most before it is sent.
FOREST = 200_000


def _edges(forest: Forest) -> Iterator[pa.RecordBatch]:
    nodes = [x for x in forest.up if forest.find(x) != x]
    for k in range(0, len(nodes), 50_000):
        part = nodes[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(part, dtype=U64).view(np.int64)), pa.array(np.array([forest.find(x) for x in part], dtype=U64).view(np.int64))], names=["u", "v"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; a task holds one bucket at a time and a forest of bounded size."""
    forest = Forest()
    flips = [np.array([0, *(1 << b for b in range(64) if m >> b & 1)], dtype=U64) for m in PAIRS]
    for b, rows in K.by_key(batches, "bucket"):
        c = b % len(PAIRS)
        fp = np.frombuffer(b"".join(K.column(rows, "fps").to_pylist()), U64)
        variant = (fp & U64(PAIRS[c])) ^ flips[c][np.frombuffer(b"".join(K.column(rows, "bits").to_pylist()), np.uint8)]
        order = np.argsort(variant, kind="stable")
        v, fp = variant[order], fp[order]
        fresh = np.ones(len(v), bool)
        fresh[1:] = v[1:] != v[:-1]
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(v)))
        several = size > 1
        first, size = first[several], size[several]
        for lag in range(1, SMALL):
            at = np.concatenate([first[(size > lag + k) & (size <= SMALL)] + k for k in range(SMALL - lag)])
            near = np.bitwise_count(fp[at] ^ fp[at + lag]) <= RADIUS
            for x, y in zip(fp[at[near]].tolist(), fp[at[near] + lag].tolist()):
                forest.join(x, y)
        for f, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
            _trees(fp[f : f + n], forest)
        if len(forest.up) > FOREST:
            yield from _edges(forest)
            forest = Forest()
    yield from _edges(forest)


def links(prints: DataFrame) -> DataFrame:
    """(u, v): forests over the linked values of stored rows of different ``fp``."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = prints.count()
    tasks, per_pair = max(1, min(n, -(-count // TASK))), max(n, -(-count * 44 // BUCKET))
    balls = prints.select("fp").repartition(tasks).transform(K.mapped, _ball(per_pair), "bucket int, fps binary, bits binary")
    return balls.repartition("bucket").sortWithinPartitions("bucket").transform(K.mapped, _verify, "u long, v long")


def classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of stored (doc_id, fp) rows; root is the component's least fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    linked = components(links(distinct))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(named.join(least, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, uid, fp, root and component_id, one row per document."""
    prints = stored(fingerprints(docs, shingle), "fingerprints", wide=True)
    return prints.join(classes(prints), "fp", "left")


def keep_one(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """The rows of docs that stand for their component: one of each, the least (doc_id, text hash).

    Repeated rows of the kept document are reduced to one row.
    """
    return one_of_each(docs, near_duplicates(docs, shingle))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The least (doc_id, text hash) of each root among found's rows of doc_id, uid and root."""
    found = found.withColumn("key", F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "uid"))
    counted = found.groupBy("root", "key").agg(F.count("*").alias("n"))
    keep = stored(counted.groupBy("root").agg(F.min(F.struct("key", "n")).alias("k")).select("k.key.doc_id", "k.key.uid", "k.n"), "keepers")
    keyed = docs.withColumn("_tm_uid", F.xxhash64("text"))

    def held(few: DataFrame) -> DataFrame:
        few = few.select(F.col("doc_id").alias("_tm_id"), F.col("uid").alias("_tm_key"))
        return keyed.join(few, keyed["doc_id"].eqNullSafe(few["_tm_id"]) & (keyed["_tm_uid"] == few["_tm_key"]), "left_semi")

    out = held(keep.where("n = 1"))
    if not keep.where("n > 1").isEmpty():
        out = out.unionByName(held(keep.where("n > 1")).dropDuplicates(["doc_id", "_tm_uid"]))
    return out.drop("_tm_uid")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op8."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
