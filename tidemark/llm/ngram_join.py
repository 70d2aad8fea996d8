"""N-gram Jaccard join by signature trees: every document's class of texts whose shingle sets overlap almost wholly.

Texts are lower-cased (A-Z) and split into words; a text's set holds its distinct shingles of ``shingle`` = 3 words (fewer words:
the whole sequence; none: empty). Two texts link where 100 times the size of the sets' intersection is at least
``percent`` = 90 times that of their union. Shingles are 64-bit hashes; texts with equal sets (two 64-bit hashes) are one node.

Nodes meet in a tree only where they may link. Linked sets of sizes a and b differ in at most
k = (a + b)(100 - percent) / (100 + percent) shingles. Sizes are cut into intervals; for each, shingles are dealt by hash into k + 1
parts, of which linked sets agree on one wholly. So a node goes to as many keys: hashes of each part's content (about eight
shingles, so texts that merely share a passage do not meet), also in the next interval if its size lies within the percentage of that.
A part without shingles is a key only together with the parts of a second and third dealing. No linked pair is missed.

Nodes of a key form a signature tree: leaves are sets as bitmaps over the shingles that several of the key's sets hold, inner nodes
the OR of ``FANOUT`` children with their least and largest size. Pairs of tree nodes are walked down together and
pruned if their sizes are too far apart, if all below them is one component already, or if the overlap possible at most,
the common bits, is less than the smallest sizes below need. Pairs of leaves are decided by their exact overlap. A task
sends a spanning forest of what it found.

1. A key's least node leads it; each node is compared in the tree of the least of its leaders, and components are settled.
2. Only keys that still hold several components are compared whole, all keys of one leader in one tree, so a set is sent
   once a leader. Where there are more nodes than a tree takes (``BLOCK`` nodes, ``TOKENS`` shingles) they are cut into blocks,
   in the second round by component, and all pairs of blocks are compared that are not of one component alone. No row
   is made of a pair of documents.

The work of the second round grows with the square of a group of texts that agree on a whole part, hence are alike to
some 70 percent or more, and still do not link; groups of linked texts cost as many rows as they have members.

Defined cases: null and empty texts, and texts without words, have an empty set and link with nothing; repeated rows and equal ids are
documents of their own; a null doc_id belongs to its component but never names it (a component of null ids only has a null id);
very long texts need about 100 bytes of memory a byte in one task; extra columns are ignored, whatever their names; empty
table: empty result. More than 50 rounds of the components (longer chains than any seen) raise a RuntimeError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm.components import components
from tidemark.llm.durable import stored
from tidemark.llm.simhash import Forest

U64 = np.uint64
PERCENT, SHINGLE = 90, 3
#: Nodes and shingles of a block, and children of a tree's node.
BLOCK, TOKENS, FANOUT = 512, 1 << 21, 8
#: Words of bitmaps that a step of a tree's traversal reads.
STEP = 1 << 20
#: Longs of the bitmaps that sieve keys and texts before they are shuffled.
WORDS = 1 << 20
#: Sets that share their first hash with another: none is expected below a billion sets.
ALIKE = 1000
#: Dealings of shingles to parts that are tried for empty parts.
DEALINGS = 3


def _lows() -> np.ndarray:
    """Least sizes of the intervals: each one and a half times the one before."""
    out = [1, 2, 3]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 3 // 2 + out[-1] % 2)
    return np.array(out, np.int64)


LOWS = _lows()


def parts_of(interval: np.ndarray, percent: int) -> np.ndarray:
    """Parts of each interval: one more than the most shingles in which two linked sets of its sizes differ."""
    most = LOWS[interval + 1] - 1
    return 2 * most * (100 - percent) // (100 + percent) + 1


def token_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every document, ascending, and the n + 1 places at which documents begin."""
    data = K.LOWER[data]
    starts, ends, at = K.words(data, offsets, K.NOT_SPACE)
    prefix = K.prefix_hash(K.word_hashes(data, starts, ends), K.BASE_A)
    size = np.diff(at)
    count = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(len(size)), count)
    lo = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][doc]
    hi = np.minimum(lo + shingle, at[1:][doc])
    h = K.mix(K.range_hash(prefix, lo, hi, K.BASE_A) ^ (hi - lo).astype(U64))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[fresh], doc[fresh]
    return h, np.searchsorted(doc, np.arange(len(size) + 1))


def set_hashes(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each document's set; zero for the empty set."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((2, len(at) - 1), U64)
    if len(full):
        size = np.diff(at)[full].astype(U64)
        for k, base in enumerate((K.BASE_A, K.BASE_B)):
            out[k, full] = K.mix(np.add.reduceat(K.mix((h ^ U64(base)) * U64(base)), at[:-1][full]) ^ size)
    return out[0], out[1]


def _dealt(h: np.ndarray, entry: np.ndarray, parts: np.ndarray, dealing: int) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of the content of every entry's every part, its number of shingles); entry: that of each shingle."""
    base = np.cumsum(parts) - parts
    spread = K.mix(h + U64(K.BASE_BYTES * (dealing + 1) % (1 << 64)))
    at = base[entry] + ((spread >> U64(33)).astype(np.int64) % parts[entry])
    total = np.zeros(int(parts.sum()), U64)
    np.add.at(total, at, K.mix(h ^ U64(K.BASE_B)))
    return total, np.bincount(at, minlength=len(total))


def _within(h: np.ndarray, parts: int, dealing: int, name: int) -> list[int]:
    """Keys of one set under a name: one a part, for empty parts those of the next dealing."""
    total, count = _dealt(h, np.zeros(len(h), np.int64), np.array([parts]), dealing)
    keys = K.mix(total ^ K.mix(np.arange(parts, dtype=U64) ^ U64(name)))
    out = keys[count > 0].tolist()
    for k in np.flatnonzero(count == 0).tolist():
        out += [int(keys[k])] if dealing + 1 == DEALINGS else _within(h, parts, dealing + 1, int(keys[k]))
    return out


def keys_of(h: np.ndarray, at: np.ndarray, percent: int) -> list[np.ndarray]:
    """The keys of each document's set."""
    size = np.diff(at)
    out: list[list[np.ndarray]] = [[] for _ in size]
    interval = np.searchsorted(LOWS, size, "right") - 1
    for ahead in (0, 1):
        t = interval + ahead
        doc = np.flatnonzero((size > 0) & (100 * size >= percent * LOWS[t]))
        doc = doc[parts_of(t[doc], percent) > 1]
        if not len(doc):
            continue
        parts, n = parts_of(t[doc], percent), size[doc]
        entry = np.repeat(np.arange(len(doc)), n)
        which = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + at[:-1][doc][entry]
        total, count = _dealt(h[which], entry, parts, 0)
        base = np.cumsum(parts) - parts
        owner = np.repeat(np.arange(len(doc)), parts)
        keys = K.mix(total ^ K.mix((np.arange(len(total)) - base[owner]).astype(U64) ^ (t[doc][owner].astype(U64) << U64(40))))
        kept = np.split(keys[count > 0], np.cumsum(np.bincount(owner[count > 0], minlength=len(doc)))[:-1])
        for d, own in zip(doc.tolist(), kept):
            out[d].append(own)
        for k in np.flatnonzero(count == 0).tolist():
            d = int(doc[owner[k]])
            out[d].append(np.array(_within(h[at[d] : at[d + 1]], int(parts[owner[k]]), 1, int(keys[k])), dtype=U64))
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, U64) for x in out]


def _sign(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            for i, j, d, o in K.blocks(data, offsets):
                h, at = token_sets(d, o, shingle)
                ha, hb = set_hashes(h, at)
                yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id").slice(i, j - i), K.column(batch, "who").slice(i, j - i), pa.array(np.diff(at)), pa.array(ha.view(np.int64)), pa.array(hb.view(np.int64))], names=["doc_id", "who", "n", "ha", "hb"])

    return run


def _keys(shingle: int, percent: int, renamed: dict[tuple[int, int], int]):
    """Each text's node, its number of shingles and its keys; renamed: nodes of sets that share their first hash with another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            for _, _, d, o in K.blocks(data, offsets):
                h, at = token_sets(d, o, shingle)
                ha, hb = (x.view(np.int64) for x in set_hashes(h, at))
                node = [renamed.get(x, x[0]) for x in zip(ha.tolist(), hb.tolist())] if renamed else ha
                keys = keys_of(h, at, percent)
                cut = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.diff(at)), flat], names=["node", "n", "keys"])

    return run


def _sets(shingle: int):
    """Sets of the texts that have the wanted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, "text"))
            node, ha, hb = (np.asarray(K.column(batch, c)) for c in ("node", "ha", "hb"))
            for i, j, d, o in K.blocks(data, offsets):
                h, at = token_sets(d, o, shingle)
                a, b = set_hashes(h, at)
                same = np.flatnonzero((a.view(np.int64) == ha[i:j]) & (b.view(np.int64) == hb[i:j]))
                yield pa.RecordBatch.from_arrays([pa.array(node[i:j][same]), pa.array([h[at[k] : at[k + 1]].tobytes() for k in same], pa.binary())], names=["node", "own"])

    return run


class Level:
    """Nodes of one level of a signature tree: bitmaps, sizes, and the components and sides below them."""

    def __init__(self, bits: np.ndarray, lo: np.ndarray, hi: np.ndarray, marks: np.ndarray) -> None:
        """marks: rows of component and side of each node, each as least and largest."""
        self.bits, self.lo, self.hi, self.marks = bits, lo, hi, marks

    def above(self) -> Level:
        first = np.arange(0, len(self.lo), FANOUT)
        least, most = self.marks[::2], self.marks[1::2]
        marks = np.empty((4, len(first)), np.int64)
        marks[::2], marks[1::2] = np.minimum.reduceat(least, first, axis=1), np.maximum.reduceat(most, first, axis=1)
        return Level(np.bitwise_or.reduceat(self.bits, first, axis=0), np.minimum.reduceat(self.lo, first), np.maximum.reduceat(self.hi, first), marks)

    def may_link(self, i: np.ndarray, j: np.ndarray, percent: int, sides: bool) -> np.ndarray:
        """Which pairs of nodes may hold linked sets; for leaves exactly those that do."""
        ok = (100 * self.hi[i] >= percent * self.lo[j]) & (100 * self.hi[j] >= percent * self.lo[i])
        for k in range(2 if sides else 1):  # all of one component, or all of one side where only pairs across are asked for
            least, most = self.marks[2 * k], self.marks[2 * k + 1]
            ok &= ~((least[i] == most[i]) & (least[j] == most[j]) & (least[i] == least[j]))
        at = np.flatnonzero(ok)
        for k in range(0, len(at), step := max(1, STEP // max(1, self.bits.shape[1]))):
            x, y = i[at[k : k + step]], j[at[k : k + step]]
            both = np.bitwise_count(self.bits[x] & self.bits[y]).sum(axis=1, dtype=np.int64)
            both = np.minimum(both, np.minimum(self.hi[x], self.hi[y]))
            ok[at[k : k + step]] = (100 + percent) * both >= percent * (self.lo[x] + self.lo[y])
        return ok


def linked(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Linked pairs of sets, enough to join all components that such pairs join; where there are two sides, of pairs across."""
    size = np.array([len(x) for x in sets], np.int64)
    if len(sets) < 2:
        return []
    tokens = np.concatenate(sets)
    table, number, times = np.unique(tokens, return_inverse=True, return_counts=True)
    sides = len(np.unique(side)) > 1
    # similar sets stand side by side: by side, least shingle and size
    first = table[number[np.cumsum(size) - size]] if len(tokens) else np.zeros(len(sets), U64)
    order = np.lexsort((size, first, side))
    place = np.empty(len(sets), np.int64)
    place[order] = np.arange(len(sets))
    common = times > 1
    column = np.cumsum(common) - 1
    use = common[number]
    width = max(1, -(-int(common.sum()) // 64))
    bits = np.zeros(len(sets) * width, U64)
    col = column[number[use]]
    np.bitwise_or.at(bits, place[np.repeat(np.arange(len(sets)), size)[use]] * width + col // 64, U64(1) << (col % 64).astype(U64))
    _, comp = np.unique(root[order], return_inverse=True)
    marks = np.stack([comp, comp, side[order], side[order]]).astype(np.int64)
    levels = [Level(bits.reshape(len(sets), width), size[order], size[order], marks)]
    while len(levels[-1].lo) > FANOUT:
        levels.append(levels[-1].above())
    i, j = np.triu_indices(len(levels[-1].lo))
    forest, found = Forest(), []
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        if depth == 0:
            i, j = i[i < j], j[i < j]
        ok = level.may_link(i, j, percent, sides)
        i, j = i[ok], j[ok]
        if depth:
            below = len(levels[depth - 1].lo)
            grid = np.arange(FANOUT)
            a = (i[:, None, None] * FANOUT + grid[None, :, None] + 0 * grid[None, None, :]).ravel()
            b = (j[:, None, None] * FANOUT + grid[None, None, :] + 0 * grid[None, :, None]).ravel()
            inside = (a < below) & (b < below) & (a <= b)
            i, j = a[inside], b[inside]
    for a, b in zip(order[i].tolist(), order[j].tolist()):
        x, y = forest.find(int(root[a])), forest.find(int(root[b]))
        if x != y:
            forest.join(x, y)
            found.append((a, b))
    return found


def _trees(percent: int):
    """Rows sorted by group: the links that each group's tree finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in K.by_key(batches, "gid"):
            node, root, side = (np.asarray(K.column(rows, c)) for c in ("node", "root", "side"))
            sets = [np.frombuffer(x, U64) for x in K.column(rows, "own").to_pylist()]
            pairs = [(int(node[a]), int(node[b])) for a, b in linked(sets, root, side, percent)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["u", "v"])

    return run


def _sieved(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows whose key is known, and few others: a bitmap of WORDS longs picks them before anything is shuffled."""
    place, bit = F.col(key).bitwiseAND(WORDS - 1), F.expr(f"shiftleft(1L, cast(shiftright({key}, 40) & 63 as int))")
    marks = known.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("marks"))
    return rows.join(F.broadcast(marks), place == marks["place"]).where(F.col("marks").bitwiseAND(bit) != 0).drop("place", "marks")


def _room(n: Column) -> Column:
    """Nodes of sets of up to n shingles that a block takes."""
    return F.greatest(F.lit(8), F.least(F.lit(BLOCK), F.floor(F.lit(TOKENS) / n))).cast("long")


def _home_groups(members: DataFrame) -> DataFrame:
    """gid, node, side and root: each node with the least of the nodes that lead its keys, in blocks that all hold that one."""
    homes = members.groupBy("node").agg(F.min("least").alias("least"), F.first("n").alias("n"))
    sizes = homes.groupBy("least").agg(F.count("*").alias("count"), _room(F.max("n")).alias("room"))
    blocks = F.ceil(F.col("count") / F.col("room"))
    each = homes.join(sizes, "least").select(F.xxhash64("least", F.pmod(F.xxhash64("node"), blocks)).alias("gid"), "node", "least")
    both = each.select("gid", "node").unionByName(each.select("gid", F.col("least").alias("node"))).distinct()
    return both.withColumn("side", F.lit(0)).withColumn("root", F.col("node"))


def _mixed_groups(placed: DataFrame) -> DataFrame:
    """gid, node, side and root of all keys that one node leads; large groups as pairs of blocks, cut by component."""
    sizes = placed.groupBy("least").agg(F.count("*").alias("count"), _room(F.max("n")).alias("room"))
    rows = placed.join(sizes, "least")
    light = rows.where("count <= room").select(F.col("least").alias("gid"), "node", F.lit(0).alias("side"), "root")
    heavy = rows.where("count > room")
    if heavy.isEmpty():
        return light
    own = heavy.groupBy("least", "root").agg(F.count("*").alias("own"))
    big = F.col("own") >= F.col("room")
    cuts = F.when(big, F.ceil(F.col("own") / F.col("room"))).otherwise(F.ceil(F.col("count") / F.col("room")))
    block = F.when(big, F.xxhash64("root", F.pmod(F.xxhash64("node"), cuts))).otherwise(F.xxhash64(F.pmod(F.xxhash64("root"), cuts)))
    cut = stored(heavy.join(own, ["least", "root"]).select("least", "node", "root", block.alias("block")), "blocks", wide=True)
    kinds = cut.groupBy("least", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    a, b = kinds.alias("a"), kinds.alias("b")
    apart = (F.col("a.lo") != F.col("a.hi")) | (F.col("b.lo") != F.col("b.hi")) | (F.col("a.lo") != F.col("b.lo"))
    pairs = a.join(b, (F.col("a.least") == F.col("b.least")) & (F.col("a.block") <= F.col("b.block")) & apart)
    pairs = pairs.select("a.least", F.col("a.block").alias("x"), F.col("b.block").alias("y"))
    sides = pairs.select("least", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    dealt = sides.join(cut, ["least", "block"])
    return light.unionByName(dealt.select(F.xxhash64("least", "x", "y").alias("gid"), "node", (F.col("block") != F.col("x")).cast("int").alias("side"), "root"))


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node and root (null for empty sets) and component_id, one row a document."""
    kind = dict(docs.dtypes)["doc_id"]
    who = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    keyed = docs.select("doc_id", who.alias("who"), F.col("text").cast("string").alias("text"))
    signed = stored(keyed.transform(K.mapped, _sign(shingle), f"doc_id {kind}, who long, n long, ha long, hb long"), "signed", wide=True)
    # one node for each set, one document for each node; a node is named by its first hash unless two sets share that
    sets_of = stored(signed.where("n > 0").groupBy("ha", "hb").agg(F.min("who").alias("who"), F.min("doc_id").alias("least_id")), "sets")
    alike = sets_of.join(sets_of.groupBy("ha").count().where("count > 1"), "ha").select("ha", "hb", F.xxhash64("ha", "hb").alias("node"))
    renamed = {(r["ha"], r["hb"]): r["node"] for r in alike.limit(ALIKE + 1).collect()}
    if len(renamed) > ALIKE:
        raise RuntimeError("set hashes collide")
    own = F.col("ha")
    for (a, b), node in renamed.items():
        own = F.when((F.col("ha") == a) & (F.col("hb") == b), F.lit(node)).otherwise(own)
    nodes = sets_of.withColumn("node", own)
    # keys are made anew for each use, which is less than writing them
    texts = _sieved(keyed.select("who", "text"), nodes.select("who"), "who")
    flat = texts.select("text").transform(K.mapped, _keys(shingle, percent, renamed), "node long, n long, keys array<long>").select("node", "n", F.explode("keys").alias("key"))
    shared = stored(flat.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("key", "least"), "shared", wide=True)
    members = stored(_sieved(flat, shared, "key").join(shared, "key").dropDuplicates(["key", "node"]).select("key", "node", "n", "least"), "members", wide=True)
    known = stored(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "who", "ha", "hb"), "known")
    wanted = _sieved(keyed.select("who", "text"), known, "who").join(known, "who").select("node", "ha", "hb", "text")
    sets = stored(wanted.transform(K.mapped, _sets(shingle), "node long, own binary").dropDuplicates(["node"]), "sets", wide=True)

    def links(groups: DataFrame) -> DataFrame:
        rows = groups.join(sets, "node").select("gid", "node", "root", "side", "own")
        return stored(rows.repartition("gid").sortWithinPartitions("gid").transform(K.mapped, _trees(percent), "u long, v long"), "links")

    edges = links(_home_groups(members))
    roots = stored(components(edges), "roots")
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    found = links(_mixed_groups(stored(placed.join(mixed, "key", "left_semi").select("least", "node", "n", "root").distinct(), "mixed", wide=True)))
    if not found.isEmpty():
        roots = stored(components(edges.unionByName(found)), "roots")
    named = nodes.select("ha", "hb", "node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of = stored(named.join(ids, "root").select("ha", "hb", "node", "root", "component_id"), "classes")
    own = signed.select("doc_id", F.col("n").alias("n_shingles"), "ha", "hb")
    full = own.where("n_shingles > 0").join(of, ["ha", "hb"]).select("doc_id", "n_shingles", "node", "root", "component_id")
    none = F.lit(None).cast("long")
    return full.unionByName(own.where("n_shingles = 0").select("doc_id", "n_shingles", none.alias("node"), none.alias("root"), F.col("doc_id").alias("component_id")))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op11."""
    return classes(docs).select("doc_id", "n_shingles", "component_id")
