"""Near-duplicates by Jaccard similarity of word shingles: SimHash balls and MinHash keys propose pairs, exact sets decide.

Texts are lower-cased (A-Z) and split into words; a text's set holds the hashes (48 bits) of its
shingles of ``shingle`` words (fewer words: the whole sequence; none: the empty set). Two texts link
where the Jaccard similarity of their sets is ``least`` = 0.8 or more; components of links are
duplicates. Texts with equal sets are one node.

1. Fingerprints of :mod:`tidemark.llm.simhash` over the same shingles meet in the middle of their
   balls; the sets decide each link of the forests that come back.
2. At a similarity of 0.8 about a seventh of a fingerprint's bits differ, which radius 4 seldom
   reaches; balls for it would take some 1,500 variants a text. So ``BANDS`` = 32 keys of ``ROWS`` = 5
   MinHashes complete the search: a pair at 0.8 shares none with probability (1 - 0.8 ** 5) ** 32 =
   3e-6. Of keys whose nodes are in different components, each node is compared with the key's least.
3. In keys that still hold several components all pairs between components are compared, in
   blocks of ``BLOCK`` nodes that a task counts against each other without making a row of a pair.
   A group of near copies, however large, is joined by the rounds before; only texts that share a
   key without being linked come here.

A task keeps a spanning forest of the links it found. Texts are only sent for nodes that are to be
compared (a bitmap of :data:`WORDS` longs sieves them; what it lets through by chance is dropped).

A very long text takes about 100 bytes of memory a byte in one task; components raise a RuntimeError after 50 rounds.

Defined cases: null and empty texts link with each other; a null doc_id is kept only where its
component has no other; repeated rows of the kept document are reduced to one; extra columns pass
through; names that begin with ``_tm_`` are reserved; empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.durable import stored
from tidemark.llm.simhash import Forest, one_of_each

U64 = np.uint64
LEAST = 0.8
BANDS, ROWS = 32, 5
#: Nodes of a key that a task holds of either side.
BLOCK = 256
#: Longs of the bitmap of texts to send.
WORDS = 1 << 18
#: One odd multiplier and one mask for each MinHash.
SEEDS = K.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=U64) * U64(K.BASE_A))
TIMES, MASKS = SEEDS[: BANDS * ROWS] | U64(1), SEEDS[BANDS * ROWS :]


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every document, ascending, and the n + 1 places at which documents begin."""
    data = K.LOWER[data]
    starts, ends, at = K.words(data, offsets, K.NOT_SPACE)
    prefix = K.prefix_hash(K.word_hashes(data, starts, ends), K.BASE_A)
    size = np.diff(at)
    count = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(len(size)), count)
    lo = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][doc]
    hi = np.minimum(lo + shingle, at[1:][doc])
    h = K.mix(K.range_hash(prefix, lo, hi, K.BASE_A) ^ (hi - lo).astype(U64)) >> U64(16)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[fresh], doc[fresh]
    return h, np.searchsorted(doc, np.arange(len(size) + 1))


def signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each document's set, its keys as one row of BANDS); documents without a shingle have zeros."""
    full = np.flatnonzero(np.diff(at))
    first = at[:-1][full]
    sets, keys = np.zeros(len(at) - 1, U64), np.zeros((len(at) - 1, BANDS), U64)
    if len(full):
        sets[full] = K.mix(np.add.reduceat(K.mix(h ^ U64(K.BASE_B)), first) ^ np.diff(at)[full].astype(U64))
        for b in range(BANDS):
            key = np.full(len(full), b + 1, U64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = K.mix(key ^ np.minimum.reduceat((h ^ MASKS[k]) * TIMES[k], first)) * U64(K.BASE_A)
            keys[full, b] = key
    return sets, keys


def _sign(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            for i, j, d, o in K.blocks(data, offsets):
                h, at = shingles(d, o, shingle)
                sets, keys = signatures(K.mix(h), at)
                raw, cuts = d.tobytes(), o.tolist()
                prints = np.array([simhash.fingerprint(raw[a:b], shingle) for a, b in zip(cuts, cuts[1:])], dtype=U64)
                cut = np.concatenate(([0], np.cumsum(np.where(np.diff(at) > 0, BANDS, 0)))).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(cut), pa.array(keys[np.diff(at) > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id").slice(i, j - i), K.column(batch, "uid").slice(i, j - i), pa.array(sets.view(np.int64)), pa.array(prints.view(np.int64)), flat], names=["doc_id", "uid", "node", "fp", "keys"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            for i, j, d, o in K.blocks(data, offsets):
                h, at = shingles(d, o, shingle)
                yield pa.RecordBatch.from_arrays([K.column(batch, "node").slice(i, j - i), pa.array([packed(h[a:b]) for a, b in zip(at, at[1:])], pa.binary())], names=["node", "own"])

    return run


def packed(h: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def similar(a: bytes, b: bytes, least: float) -> bool:
    """Whether two sets of distinct hashes have a Jaccard similarity of ``least`` or more."""
    n, m = len(a) // 6, len(b) // 6
    if min(n, m) < least * max(n, m):
        return False
    both = len(np.intersect1d(unpacked(a), unpacked(b), assume_unique=True))
    return both >= least * (n + m - both)


def _edges(forest: Forest) -> Iterator[pa.RecordBatch]:
    nodes = [x for x in forest.up if forest.find(x) != x]
    for k in range(0, len(nodes), 50_000):
        part = nodes[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.find(x) for x in part], pa.int64())], names=["u", "v"])


def _decide(least: float):
    """A spanning forest of a task's linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for u, v, a, b in zip(*(K.column(batch, c) for c in ("u", "v", "own", "other"))):
                if similar(a.as_py(), b.as_py(), least):
                    forest.join(u.as_py(), v.as_py())
            if len(forest.up) > simhash.FOREST:
                yield from _edges(forest)
                forest = Forest()
        yield from _edges(forest)

    return run


def _blocks(least: float):
    """Rows sorted by group, a pair of blocks of a key's nodes: the links between nodes of different roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in K.by_key(batches, "group"):
            node, root, block = (np.asarray(K.column(rows, c)) for c in ("node", "root", "block"))
            sets = [unpacked(x) for x in K.column(rows, "own").to_pylist()]
            size = np.array([len(x) for x in sets])
            # every set as numbers of the group's hashes
            table, number = np.unique(np.concatenate(sets), return_inverse=True)
            first = np.cumsum(size) - size
            two = len(np.unique(block)) > 1
            forest, links = Forest(), []
            for k in range(len(node) - 1):
                rest = slice(k + 1, None)
                may = (root[rest] != root[k]) & (np.minimum(size[rest], size[k]) >= least * np.maximum(size[rest], size[k]))
                if two:
                    may &= block[rest] != block[k]
                if not may.any():
                    continue
                mark = np.zeros(len(table), bool)
                mark[number[first[k] : first[k] + size[k]]] = True
                both = np.add.reduceat(mark[number[first[k + 1] :]], first[rest] - first[k + 1], dtype=np.int64)
                for x in (k + 1 + np.flatnonzero(may & (both >= least * (size[rest] + size[k] - both)))).tolist():
                    a, b = int(root[k]), int(root[x])
                    if forest.find(a) != forest.find(b):
                        forest.join(a, b)
                        links.append((int(node[k]), int(node[x])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["u", "v"])

    return run


def _sieved(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of texts whose uid is known, and few others, without sending a text."""
    place, bit = F.col("uid").bitwiseAND(WORDS - 1), F.expr("shiftleft(1L, cast(shiftright(uid, 40) & 63 as int))")
    marks = known.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("marks"))
    return texts.join(F.broadcast(marks), place == marks["place"]).where(F.col("marks").bitwiseAND(bit) != 0).drop("place", "marks")


def near_duplicates(docs: DataFrame, shingle: int = 5, least: float = LEAST) -> DataFrame:
    """doc_id, uid (a hash of the text), node and root (of the component), one row per document."""
    kind = dict(docs.dtypes)["doc_id"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("uid"), F.col("text").cast("string").alias("text"))
    signed = stored(keyed.transform(K.mapped, _sign(shingle), f"doc_id {kind}, uid long, node long, fp long, keys array<long>"), "signatures", wide=True)
    # one text stands for each node
    nodes = stored(signed.where(F.size("keys") > 0).groupBy("node").agg(F.min("uid").alias("uid"), F.min("fp").alias("fp"), F.first("keys").alias("keys")), "nodes")
    # balls of fingerprints: nodes of one fingerprint, and the least nodes of linked fingerprints
    prints = stored(nodes.groupBy("fp").agg(F.min("node").alias("least")), "prints")
    same = nodes.join(prints, "fp").select(F.col("node").alias("u"), F.col("least").alias("v"))
    ends = [prints.select(F.col("fp").alias(c), F.col("least").alias(f"n{c}")) for c in "uv"]
    balls = simhash.links(prints).join(ends[0], "u").join(ends[1], "v").select(F.col("nu").alias("u"), F.col("nv").alias("v"))
    tried = stored(same.unionByName(balls).where("u <> v").distinct(), "pairs")
    # keys
    flat = nodes.select("node", F.explode("keys").alias("key"))
    shared = flat.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v <> w").select("key", "v")
    members = stored(flat.join(shared, "key").select("key", F.col("node").alias("u"), "v"), "members", wide=True)
    compared = members.select(F.col("u").alias("node")).union(tried.select("u")).union(tried.select("v")).distinct()
    known = stored(nodes.select("node", "uid").join(compared, "node", "left_semi"), "known")
    texts = _sieved(keyed.select("uid", "text"), known).join(known, "uid").dropDuplicates(["node"]).select("node", "text")
    sets = stored(texts.transform(K.mapped, _sets(shingle), "node long, own binary"), "sets", wide=True)

    def links(pairs: DataFrame) -> DataFrame:
        left = pairs.join(sets.withColumnRenamed("node", "u"), "u")
        both = left.join(sets.select(F.col("node").alias("v"), F.col("own").alias("other")), "v")
        return stored(both.select("u", "v", "own", "other").transform(K.mapped, _decide(least), "u long, v long"), "links")

    def named(edges: DataFrame) -> DataFrame:
        return stored(components(edges).withColumnRenamed("node", "u"), "roots")

    def mixed(roots: DataFrame) -> DataFrame:
        """The members, with their roots, of the keys that hold several components."""
        placed = members.join(roots, "u", "left").withColumn("root", F.coalesce("root", "u"))
        keys = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).where("a <> b").select("key", "n")
        return stored(placed.join(keys, "key"), "mixed")

    edges = links(tried)
    roots = named(edges)
    placed = mixed(roots)
    hubs = placed.where("u = v").select("key", F.col("root").alias("other"))
    star = placed.join(hubs, "key").where("root <> other").select("u", "v").distinct()
    found = links(star.join(tried, ["u", "v"], "left_anti"))
    if not found.isEmpty():
        edges = edges.unionByName(found)
        roots = named(edges)
        placed = mixed(roots)
    # every member goes to the pairs of blocks that its block is part of
    count = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = placed.select("key", F.col("u").alias("node"), "root", count.alias("count"), F.pmod(F.xxhash64("u"), count).alias("block"))
    dealt = dealt.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    dealt = dealt.withColumn("group", F.xxhash64("key", F.least("block", "k"), F.greatest("block", "k")))
    rows = dealt.join(sets, "node").select("group", "node", "root", "block", "own")
    found = stored(rows.repartition("group").sortWithinPartitions("group").transform(K.mapped, _blocks(least), "u long, v long"), "links")
    if not found.isEmpty():
        roots = named(edges.unionByName(found))
    return signed.select("doc_id", "uid", "node").join(roots.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def keep_one(docs: DataFrame, shingle: int = 5, least: float = LEAST) -> DataFrame:
    """The rows of docs that stand for their component: one of each, the least (doc_id, text hash)."""
    return one_of_each(docs, near_duplicates(docs, shingle, least))
