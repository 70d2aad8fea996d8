"""Line dedup by pairwise alignment with patience diff.

Lines are compared by a 64-bit hash of their words (runs of white space count as one space; lines
without a word are not compared). A document is paired with the first holders - the smallest
(doc_id, text hash) - of the rare lines that it shares with earlier documents, so a line held by a
million documents makes a million pairs, not their square.

A shared line's rarity is the number of documents that hold it. Within every maximal run of
consecutive shared lines the rarest line names the run's partner (ties: the earlier line), and the
document is aligned with that partner; shared lines that the alignment leaves uncovered name their
own first holders in a second round, so no shared line is ever skipped for being common. What is
still uncovered stands in another order or more often than there: in a third round the two pairs of
neighbouring lines that it is part of (the document's start and end count as lines) name the first
holders of these pairs, and an n-th occurrence the first document with as many. What even that leaves
uncovered names the first holders in each of ``SOME`` shares of the documents, and what then remains
the first holder of each layout: a document's lines that others hold too, in order, with a mark wherever lines of
its own stand between them. Documents of one layout align alike with any other one, so no aligned line is lost, and
a template that changed its order makes as many pairs as documents times layouts. Only texts that each arrange their
shared lines in another way make more. Alignment:
patience diff (unique common lines, longest increasing run, recursion between them, blocks grown at
both ends). Aligned common blocks of at least ``min_words`` = 1 words, so all of them, are deleted
from the later document; deletions of all pairs of a document are united.

What crosses the network are line hashes, never texts, until the final join of deletions.

Defined cases: null and empty texts have no lines and are returned as they are; a null doc_id is
later than any other; rows that repeat both doc_id and text count as one document and get equal
results; rows that repeat a doc_id with another text are ordered by text hash; kept lines are
joined by one newline exactly as they stood; a doc_id of another than an integer type is refused
with a TypeError; extra columns pass through, ``n_lines`` and ``n_removed`` are replaced; names that
begin with ``_tm_`` are reserved; empty table: empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored
from tidemark.llm.packed import order_of

U64 = np.uint64
MIN_WORDS = 1
SOME = 16
NEWLINE = np.arange(256) == 10


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every line with a word, its hash, its number of words, and where documents begin."""
    first, last, at = K.words(data, offsets, ~NEWLINE)
    starts, ends, _ = K.words(data, offsets, K.NOT_SPACE)
    h = K.word_hashes(data, starts, ends)
    lo, hi = np.searchsorted(starts, first), np.searchsorted(starts, last)
    full = hi > lo
    prefix = K.prefix_hash(h, K.BASE_A)
    lines = K.mix(K.range_hash(prefix, lo[full], hi[full], K.BASE_A) ^ (hi - lo)[full].astype(U64))
    return first[full], last[full], lines, (hi - lo)[full], np.concatenate(([0], np.cumsum(full)))[at]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets, _ = K.buffers(K.column(batch, "text"))
        h, n, size = [], [], []
        for _, _, d, o in K.blocks(data, offsets):
            _, _, lines, count, at = line_hashes(d, o)
            h.append(lines.view(np.int64))
            n.append(count.astype(np.int32))
            size.append(np.diff(at))
        cut = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(size or [np.zeros(0, np.int64)])))).astype(np.int32))
        flat = lambda x, t: pa.ListArray.from_arrays(cut, pa.array(np.concatenate(x or [np.zeros(0, t)])))
        yield pa.RecordBatch.from_arrays([K.column(batch, "ord"), K.column(batch, "uid"), flat(h, np.int64), flat(n, np.int32)], names=["ord", "uid", "h", "n"])


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned equal blocks (start in a, start in b, length) in order."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, lo2, hi2 = todo.pop()
        while lo < hi and lo2 < hi2 and a[lo] == b[lo2]:
            found.append((lo, lo2))
            lo, lo2 = lo + 1, lo2 + 1
        while lo < hi and lo2 < hi2 and a[hi - 1] == b[hi2 - 1]:
            hi, hi2 = hi - 1, hi2 - 1
            found.append((hi, hi2))
        if lo >= hi or lo2 >= hi2:
            continue
        once: dict[int, int] = {}
        for i in range(lo, hi):
            once[a[i]] = -1 if a[i] in once else i
        twice: dict[int, int] = {}
        for j in range(lo2, hi2):
            if b[j] in once:
                twice[b[j]] = -1 if b[j] in twice else j
        pairs = sorted((i, twice[x]) for x, i in once.items() if i >= 0 and twice.get(x, -1) >= 0)
        chain = _increasing(pairs)
        if not chain and pairs == [] and (common := [(i, j) for i, j in _first_common(a, b, lo, hi, lo2, hi2)]):
            chain = common
        edges = [(lo - 1, lo2 - 1), *chain, (hi, hi2)]
        found += chain
        for (i, j), (i2, j2) in zip(edges, edges[1:]):
            if i + 1 < i2 and j + 1 < j2 and chain:
                todo.append((i + 1, i2, j + 1, j2))
    found.sort()
    blocks: list[tuple[int, int, int]] = []
    for i, j in found:
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1] = (blocks[-1][0], blocks[-1][1], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def _first_common(a: list[int], b: list[int], lo: int, hi: int, lo2: int, hi2: int) -> list[tuple[int, int]]:
    """Without a unique common line: the first line of a that b holds, at its first place in b."""
    place: dict[int, int] = {}
    for j in range(hi2 - 1, lo2 - 1, -1):
        place[b[j]] = j
    return next(([(i, place[a[i]])] for i in range(lo, hi) if a[i] in place), [])


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain that rises in both places (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back[k] = piles[p - 1] if p else -1
        tops[p : p + 1], piles[p : p + 1] = [j], [k]
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _align(min_words: int):
    """Line positions to delete in the later document of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for a, n, b in zip(*(K.column(batch, c).to_pylist() for c in ("h", "n", "b"))):
                own = a or []
                cut = [i for s, _, k in patience(own, b or []) if sum(n[s : s + k]) >= min_words for i in range(s, s + k)]
                gone.append(np.array(cut, np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([K.column(batch, "ord"), K.column(batch, "uid"), pa.array(gone, pa.binary())], names=["ord", "uid", "gone"])

    return run


def _links(first_round: bool):
    """Partners of each document, from its lines with their holders: one row per document in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for o, u, found, gone in zip(*(K.column(batch, c).to_pylist() for c in ("ord", "uid", "found", "gone"))):
                covered = {int(x) for g in gone or [] for x in np.frombuffer(g, np.int32)}
                best: tuple[int, int, int, int] | None = None
                before, partners = -2, set()
                for x in sorted(found, key=lambda x: x["p"]):
                    if x["p"] in covered:
                        continue
                    if first_round:
                        if x["p"] != before + 1 and best:
                            partners.add(best[2:])
                            best = None
                        mark = (x["df"], x["p"], x["o"], x["u"])
                        best = mark if best is None or mark < best else best
                    else:
                        partners.add((x["o"], x["u"]))
                    before = x["p"]
                if best:
                    partners.add(best[2:])
                out += [(o, u, *p) for p in sorted(partners)]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=["ord", "uid", "bo", "bu"])

    return run


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared lines of each document that no alignment has covered."""
    for batch in batches:
        left = []
        for found, gone in zip(*(K.column(batch, c).to_pylist() for c in ("found", "gone"))):
            covered = {int(x) for g in gone or [] for x in np.frombuffer(g, np.int32)}
            left.append(sorted({x["p"] for x in found} - covered))
        some = pa.array([bool(x) for x in left], pa.bool_())
        columns = [K.column(batch, "ord"), K.column(batch, "uid"), pa.array(left, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([c.filter(some) for c in columns], names=["ord", "uid", "open"])


def line_keys(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n + 1 keys of neighbouring lines, the document's start and end included, and for each line the key of its repeated occurrence (0: its first)."""
    ends = np.concatenate((np.ones(1, U64), h, np.full(1, 2, U64)))
    pairs = K.mix(ends[:-1] * U64(K.BASE_A) + K.mix(ends[1:]))
    order = np.lexsort((np.arange(len(h)), h))
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[order][1:] != h[order][:-1]
    nth = np.zeros(len(h), np.int64)
    at = np.arange(len(h))
    nth[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return pairs, np.where(nth > 0, K.mix(h * U64(K.BASE_B) + nth.astype(U64)), U64(0))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different keys of whole documents, or of their open lines."""
    for batch in batches:
        opened = K.column(batch, "open").to_pylist() if "open" in batch.schema.names else [None] * batch.num_rows
        found = []
        for h, places in zip(K.column(batch, "h"), opened):
            pairs, again = line_keys(np.asarray(h.values).view(U64))
            if places is not None:
                p = np.array(places)
                pairs, again = np.concatenate((pairs[p], pairs[p + 1])), again[p]
            found.append(np.unique(np.concatenate((pairs, again[again != 0]))))
        row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
        yield pa.RecordBatch.from_arrays([K.column(batch, "ord").take(row), K.column(batch, "uid").take(row), pa.array(np.concatenate(found or [np.zeros(0, U64)]).view(np.int64))], names=["ord", "uid", "k"])


def _plain_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different lines of whole documents, or their open ones."""
    for batch in batches:
        opened = K.column(batch, "open").to_pylist() if "open" in batch.schema.names else [None] * batch.num_rows
        found = [np.unique(np.asarray(h.values)[slice(None) if p is None else np.array(p)]) for h, p in zip(K.column(batch, "h"), opened)]
        row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
        yield pa.RecordBatch.from_arrays([K.column(batch, "ord").take(row), K.column(batch, "uid").take(row), pa.array(np.concatenate(found or [np.zeros(0, np.int64)]))], names=["ord", "uid", "k"])


def _layouts(own: DataFrame, shared: DataFrame) -> DataFrame:
    """ord, uid, layout: a hash of each document's shared lines in order, runs of other lines as one mark."""
    marks = own.select("ord", "uid", F.posexplode("h").alias("p", "h")).join(shared.select("h", F.col("h").alias("line")), "h", "left")
    rows = marks.groupBy("ord", "uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "line"))), lambda x: x["line"]).alias("all"))
    kept = F.filter("all", lambda x, i: x.isNotNull() | (i == 0) | F.get("all", i - 1).isNotNull())
    return rows.select("ord", "uid", F.xxhash64(F.transform(kept, lambda x: F.struct(x.isNull(), x))).alias("layout"))


def deletions(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """ord, uid and ``gone`` (pieces of line positions) of the documents that lose a line."""
    keyed = docs.select(order_of(docs).alias("ord"), F.xxhash64("text").alias("uid"), F.col("text").cast("string").alias("text"))
    lines = stored(keyed.transform(K.mapped, _lines, "ord long, uid long, h array<long>, n array<int>").where(F.size("h") > 0).dropDuplicates(["ord", "uid"]), "lines")
    # one row per (document, distinct line), then what is known of each line that has several holders
    held = lines.select("ord", "uid", F.explode(F.array_distinct("h")).alias("h"))
    shared = held.groupBy("h").agg(F.count("*").alias("df"), F.min(F.struct("ord", "uid")).alias("first"), F.max(F.struct("ord", "uid")).alias("final"))
    shared = stored(shared.where("first <> final").select("h", "df", F.col("first.ord").alias("o"), F.col("first.uid").alias("u")), "shared")
    flat = lines.select("ord", "uid", F.posexplode("h").alias("p", "h"))
    met = flat.join(shared, "h").where("o < ord or (o = ord and u < uid)")
    found = stored(met.groupBy("ord", "uid").agg(F.collect_set(F.struct("p", "df", "o", "u")).alias("found")), "found", wide=True)
    pair = "ord long, uid long, bo long, bu long"

    def aligned(links: DataFrame) -> DataFrame:
        links = stored(links, "pairs")
        later = links.join(lines, ["ord", "uid"])
        earlier = lines.select(F.col("ord").alias("bo"), F.col("uid").alias("bu"), F.col("h").alias("b"))
        cut = later.join(earlier, ["bo", "bu"]).select("ord", "uid", "h", "n", "b").transform(K.mapped, _align(min_words), "ord long, uid long, gone binary")
        return cut.groupBy("ord", "uid").agg(F.collect_list("gone").alias("gone"))

    none = F.lit(None).cast("array<binary>")
    first = stored(aligned(found.withColumn("gone", none).transform(K.mapped, _links(True), pair)), "gone")
    left = found.join(first, ["ord", "uid"], "left").transform(K.mapped, _links(False), pair)
    both = stored(first.unionByName(aligned(left)).groupBy("ord", "uid").agg(F.flatten(F.collect_list("gone")).alias("gone")), "gone")
    own = lines.select("ord", "uid", "h")
    for kind in ("around", "some", "layouts"):
        open_ = stored(found.join(both, ["ord", "uid"], "left").transform(K.mapped, _open, "ord long, uid long, open array<int>"), "open")
        if open_.isEmpty():
            break
        make = _keys if kind == "around" else _plain_keys
        keys = stored(open_.join(own, ["ord", "uid"]).transform(K.mapped, make, "ord long, uid long, k long"), "keys")
        held = own.transform(K.mapped, make, "ord long, uid long, k long").join(keys.select("k").distinct(), "k", "left_semi")
        if kind == "layouts":
            several = own.join(held.select("ord", "uid").distinct(), ["ord", "uid"], "left_semi")
            held = held.join(_layouts(several, shared), ["ord", "uid"])
            held = held.groupBy("k", "layout").agg(F.min(F.struct("ord", "uid")).alias("first")).select("k", "first.*")
        else:
            held = held.groupBy("k", F.pmod("uid", F.lit(SOME if kind == "some" else 1))).agg(F.min(F.struct("ord", "uid")).alias("first")).select("k", "first.*")
        links = keys.join(held.select("k", F.col("ord").alias("bo"), F.col("uid").alias("bu")), "k").where("bo < ord or (bo = ord and bu < uid)")
        both = stored(both.unionByName(aligned(links.select("ord", "uid", "bo", "bu").distinct())).groupBy("ord", "uid").agg(F.flatten(F.collect_list("gone")).alias("gone")), "gone")
    return both


def dedup(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the kept text in ``text``, and ``n_lines`` and ``n_removed`` (lines with a word)."""
    keep = docs.drop("n_lines", "n_removed")
    keyed = keep.withColumn("_tm_ord", order_of(docs)).withColumn("_tm_uid", F.xxhash64("text"))
    gone = deletions(docs, min_words=min_words).withColumnsRenamed({"ord": "_tm_ord", "uid": "_tm_uid", "gone": "_tm_gone"})
    joined = keyed.join(gone.hint("shuffle_hash"), ["_tm_ord", "_tm_uid"], "left").select(*keep.columns, "_tm_gone")
    schema = T.StructType([*keep.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, lost = [], [], []
            column = K.column(batch, "text")
            data, offsets, null = K.buffers(column)
            pieces = K.column(batch, "_tm_gone").to_pylist()
            for i, j, d, o in K.blocks(data, offsets):
                start, end, _, _, at = line_hashes(d, o)
                raw = d.tobytes()
                for x in range(i, j):
                    a, b = int(at[x - i]), int(at[x - i + 1])
                    cut = np.unique(np.frombuffer(b"".join(pieces[x]), np.int32)) if pieces[x] else np.zeros(0, np.int32)
                    own = raw[o[x - i] : o[x - i + 1]]
                    if len(cut):
                        drop = set((start[a + cut] - o[x - i]).tolist())
                        out, p = [], 0
                        for line in own.split(b"\n"):
                            if p not in drop:
                                out.append(line)
                            p += len(line) + 1
                        own = b"\n".join(out)
                    texts.append(None if null[x] else own)
                    total.append(b - a)
                    lost.append(len(cut))
            arrays = {k: c for k, c in zip(batch.schema.names, batch.columns) if k != "_tm_gone"}
            arrays["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*arrays.values(), pa.array(total, pa.int64()), pa.array(lost, pa.int64())], names=[*arrays, "n_lines", "n_removed"])

    return joined.transform(K.mapped, run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op4."""
    return dedup(docs.select("doc_id", F.col("text").cast("string").alias("text"))).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
