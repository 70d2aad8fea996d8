"""A Merkle manifest of a dataset: one leaf a row, one tree a group, one tree over the groups, and a proof for every row.

A leaf is H of the row's columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value; H is lower-case
hexadecimal SHA-256 of its inputs' concatenation, where digests count as their hexadecimal text. Leaves of a group ascend by
``order``; while several nodes remain, every ``FAN`` = 3 consecutive ones (the last run: fewer, even one) become their H.
What remains is the group's subroot; subroots, ordered by group (null first, UTF-8 bytewise), likewise give the root.

1. Leaves are hashed where the texts are, by column expressions; only ids and digests are sorted by range over (group,
   order), so a group with a third of all rows spreads over as many partitions as it is worth. The sorted rows are
   checkpointed, which keeps their partitions, and counts per partition and group say at which place of its group each
   partition's first leaf stands. The driver holds one such line a partition.
2. A partition builds every subtree whose leaves it holds completely. What is left at its ragged edges, a few nodes a level,
   is shuffled by coordinate: nodes below one node ``SPAN`` levels further up meet in one task, round by round.
3. Paths are handed down: from the last round to the ragged nodes, then to the partitions, which put their own levels before.

A proof is text: levels from the leaf up, joined by ``/``; a level is the node's place in its run and, each after a ``:``,
the run's other digests from left to right. :func:`fold` recomputes a root from a digest and a proof.

Defined cases: null ids come last in their group, equal ids are ordered by their leaf, repeated rows are leaves of their own;
a null id never tampers in :func:`digest`; null and empty texts differ (``-`` and ``0:``); very long texts are hashed by
Spark and never sent; extra columns are ignored, whatever their names; a table of one row has an empty proof; empty
table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K
from tidemark.llm.durable import shared_dir, stored

FAN = 3
#: Leaves of a partition, about, and the least for which one is worth it.
LEAVES, FEW = 1 << 16, 1000
#: Levels that a round of the upper tree climbs.
SPAN = 5
#: Bits of a row's number within its partition in monotonically_increasing_id.
ROW_BITS = 33
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

Node = tuple[int, int]  # level and index within the group


def hashed(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def leaf(*columns: Column) -> Column:
    """H of the columns, each with its length before it."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def above(count: int) -> int:
    """Nodes of the level above one of ``count`` nodes."""
    return -(-count // FAN)


def local_levels(digests: list[str], first: int, total: int) -> list[tuple[int, list[str]]]:
    """Of the leaves first, first + 1, ... of a group of ``total``: for each level the first index and the nodes that they make alone."""
    out = [(first, digests)]
    at, nodes, count = first, digests, total
    while count > 1:
        end = at + len(nodes)
        lo, hi = above(at), above(count) if end == count else end // FAN
        if hi <= lo:
            break
        nodes = [hashed(*nodes[FAN * p - at : FAN * p + FAN - at]) for p in range(lo, hi)]
        at, count = lo, above(count)
        out.append((at, nodes))
    return out


def ragged(levels: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the nodes whose parent is not among the levels' own."""
    for level, (at, nodes) in enumerate(levels):
        lo, hi = at + len(nodes), 0
        if level + 1 < len(levels):
            up, parents = levels[level + 1]
            lo, hi = FAN * up, FAN * (up + len(parents))
        for k, digest in enumerate(nodes, at):
            if not lo <= k < hi:
                yield level, k, digest


def step(run: list[str], place: int) -> str:
    """One level of a proof."""
    return ":".join([str(place), *run[:place], *run[place + 1 :]])


def joined(*paths: str) -> str:
    return "/".join(x for x in paths if x)


def folded(digest: str, proof: str) -> tuple[str, str]:
    """(the root that the digest and the proof give, the proof's digests joined)."""
    others = []
    for level in proof.split("/") if proof else ():
        place, *run = level.split(":")
        others += run
        run.insert(int(place), digest)
        digest = hashed(*run)
    return digest, "".join(others)


class Places:
    """Where the first leaf of each partition stands in its group, and how many leaves its first and last groups have."""

    def __init__(self, ends: list[tuple]) -> None:
        """ends: (partition, groups in it, first group, its rows there, last group, its rows there), by partition."""
        self.first: dict[int, int] = {}
        self.totals: dict[int, list[int]] = {}
        group, have, since = (), 0, []  # the group that reaches into the next partition, its leaves so far, whose total is open
        for part, n, head, n_head, tail, n_tail in ends:
            if (head,) == group:
                self.first[part] = have
            else:
                self._close(since, have)
                self.first[part], have, since = 0, 0, []
            self.totals[part] = [0, 0]
            have += n_head
            since.append((part, 0))
            if n > 1:
                self._close(since, have)
                have, since = n_tail, []
            since.append((part, 1))
            group = (tail,)
        self._close(since, have)

    def _close(self, since: list[tuple[int, int]], total: int) -> None:
        for part, end in since:
            self.totals[part][end] = total

    def groups(self, part: int, names: pa.Array) -> Iterator[tuple[str | None, int, int, int, int]]:
        """(group, first row, end row, index of the first leaf in its group, leaves of the group) of a partition's rows."""
        runs = pc.run_end_encode(names)
        ends, values = runs.run_ends.to_pylist(), runs.values.to_pylist()
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            first = self.first[part] if k == 0 else 0
            total = self.totals[part][0] if k == 0 else self.totals[part][1] if k == len(ends) - 1 else b - a
            yield values[k], a, b, first, total


NODE = "grp string, level int, idx long, digest string, total long, part int"
STEP = f"{NODE}, path string, top_level int, top_idx long, top boolean"


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


NODES = pa.schema([("grp", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("total", pa.int64()), ("part", pa.int32())])
STEPS = pa.schema([*NODES, ("path", pa.string()), ("top_level", pa.int32()), ("top_idx", pa.int64()), ("top", pa.bool_())])


def _subtrees(places: Places):
    """The ragged nodes of a partition's subtrees; each is handed to the next round with the partition that asks for its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        digests = K.column(table, "digest").to_pylist()
        part = K.column(table, "at")[0].as_py() >> ROW_BITS
        rows = []
        for group, a, b, first, total in places.groups(part, K.column(table, "grp").combine_chunks()):
            rows += [(group, level, k, digest, total, part) for level, k, digest in ragged(local_levels(digests[a:b], first, total))]
            if len(rows) > 5000:
                yield _batch(NODES, rows)
                rows = []
        yield _batch(NODES, rows)

    return run


def size_at(total: int, level: int) -> int:
    """Nodes of a level in a tree of ``total`` leaves."""
    for _ in range(level):
        total = above(total)
    return total


def _climb(limit: int):
    """All nodes below one node of level ``limit`` (or a whole lower tree): their paths up to it, and the node itself."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        group, total = rows[0]["grp"], rows[0]["total"]
        nodes: dict[Node, str] = {(r["level"], r["idx"]): r["digest"] for r in rows}
        level, now = 0, []
        while True:
            now = sorted(set(now) | {k for n, k in nodes if n == level})
            count = size_at(total, level)
            if level == limit or count == 1:
                break
            now = sorted({k // FAN for k in now})
            for k in now:
                nodes[level + 1, k] = hashed(*(nodes[level, x] for x in range(FAN * k, min(FAN * k + FAN, count))))
            level += 1
        (at,) = now
        out = [(group, level, at, nodes[level, at], total, None, "", level, at, True)]
        for r in rows:
            n, k, path = r["level"], r["idx"], []
            while n < level:
                lo = k // FAN * FAN
                run_ = [nodes[n, x] for x in range(lo, min(lo + FAN, size_at(total, n)))]
                path.append(step(run_, k - lo))
                n, k = n + 1, k // FAN
            out.append((group, r["level"], r["idx"], r["digest"], total, r["part"], joined(*path), level, at, False))
        return pa.Table.from_batches([_batch(STEPS, out)])

    return run


def _is_root(level: Column, total: Column) -> Column:
    """Whether a node is its group's last one: the tree is as high as its level."""
    height = F.lit(0)
    for n in range(1, 40):
        height = height + (total > F.lit(FAN).cast("double") ** (n - 1)).cast("int")
    return level == height


def _paths(nodes: DataFrame, per_part: int) -> DataFrame:
    """part, grp, level, idx, path (up to the subroot) and subroot of every ragged node."""
    done = nodes.where(_is_root(F.col("level"), F.col("total"))).select("part", "grp", "level", "idx", F.lit("").alias("path"), F.col("digest").alias("subroot"))
    now = nodes.where(~_is_root(F.col("level"), F.col("total")))
    limit, rounds = SPAN - 1, []
    while FAN ** (limit - SPAN + 1) < per_part:
        limit += 1
    while not now.isEmpty():
        block = F.expr(f"cast(idx div cast(round(power({FAN}, {limit} - level)) as bigint) as bigint)")
        steps = stored(now.withColumn("block", block).groupBy("grp", "block").applyInArrow(_climb(limit), STEP), "climbed", wide=True)
        rounds.append(steps)
        tops = steps.where("top")
        now = tops.where(~_is_root(F.col("level"), F.col("total"))).select(*NODES.names)
        limit += SPAN
    paths = None
    for steps in reversed(rounds):
        ends = steps.where("top and level = top_level").where(_is_root(F.col("level"), F.col("total"))).select("grp", F.col("level").alias("t"), F.col("idx").alias("k"), F.lit("").alias("up"), F.col("digest").alias("subroot"))
        if paths is not None:
            ends = ends.unionByName(paths.select("grp", F.col("level").alias("t"), F.col("idx").alias("k"), F.col("path").alias("up"), "subroot"))
        own, up = steps.where("not top").alias("a"), ends.alias("b")
        met = own.join(up, F.col("a.grp").eqNullSafe(F.col("b.grp")) & (F.col("a.top_level") == F.col("b.t")) & (F.col("a.top_idx") == F.col("b.k")))
        path = F.concat_ws("/", F.expr("nullif(a.path, '')"), F.expr("nullif(b.up, '')"))
        paths = stored(met.select("a.part", "a.grp", "a.level", "a.idx", path.alias("path"), "b.subroot"), "paths", wide=True)
    return done if paths is None else done.unionByName(paths)


def _handed(places: Places, names: list[str]):
    """Rows by partition, paths of ragged nodes first, then the leaves in order: each leaf with its whole proof."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in K.by_key(batches, "part"):
            kind = K.column(table, "kind")
            known = table.filter(pc.equal(kind, 0)).select(["grp", "level", "idx", "path", "digest", "root"])
            up = {(g, level, k): high for g, level, k, *high in zip(*(c.to_pylist() for c in known.columns))}
            (leaves,) = table.filter(pc.equal(kind, 1)).combine_chunks().to_batches()
            digests = K.column(leaves, "digest").to_pylist()
            found: list[tuple[str, str, str]] = []
            for group, a, b, first, total in places.groups(part, K.column(leaves, "grp")):
                levels = local_levels(digests[a:b], first, total)
                for k in range(first, first + b - a):
                    path = []
                    for level, (at, nodes) in enumerate(levels):
                        if (high := up.get((group, level, k))) is not None:
                            break
                        lo = k // FAN * FAN
                        path.append(step(nodes[lo - at : lo + FAN - at], k - lo))
                        k //= FAN
                    found.append((joined(*path, high[0]), high[1], high[2]))
            for a in range(0, len(found), 2000):
                rows = leaves.slice(a, 2000)
                made = dict(zip(("proof", "subroot", "root"), (pa.array(c, pa.string()) for c in zip(*found[a : a + 2000]))))
                yield pa.RecordBatch.from_arrays([made[c] if c in made else K.column(rows, "digest" if c == "leaf" else c) for c in names], names=names)

    return run


def _trees(leaves: DataFrame, order: list[str], carried: list[str], over: bool) -> DataFrame:
    """grp, the carried columns, leaf, proof, subroot and root; leaves are stored rows of grp, digest, the order and carried columns.

    over: whether a tree over the groups gives the root.
    """
    spark = leaves.sparkSession
    shared_dir(spark)
    count = leaves.count()
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // FEW), -(-count // LEAVES))
    keys = [F.col("grp").isNotNull(), F.col("grp"), *(x for c in order for x in (F.col(c).isNull(), F.col(c))), F.col("digest"), F.col("salt")]
    placed = leaves.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = placed.select("grp", "digest", *carried).withColumn("at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("at", ROW_BITS).cast("int").alias("part")
    counts = placed.groupBy(part, "grp").count()
    ends = F.struct(F.col("grp").isNotNull().alias("some"), "grp", "count")
    rows = counts.groupBy("part").agg(F.count("*").alias("n"), F.min(ends).alias("a"), F.max(ends).alias("b")).orderBy("part").collect()
    places = Places([(r["part"], r["n"], r["a"]["grp"], r["a"]["count"], r["b"]["grp"], r["b"]["count"]) for r in rows])
    nodes = stored(placed.select("at", "grp", "digest").transform(K.mapped, _subtrees(places), NODE), "ragged", wide=True)
    paths = _paths(nodes, max([1, *(r["a"]["count"] for r in rows), *(r["b"]["count"] for r in rows)]))
    if not over:
        uppers = paths.withColumn("root", F.col("subroot"))
    else:
        paths = stored(paths, "paths", wide=True)
        groups = stored(paths.select("grp", "subroot").groupBy("grp").agg(F.first("subroot").alias("digest")).select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), "digest", F.col("grp").isNotNull().cast("int").alias("some")), "subroots")
        # the tree over groups: null comes first there
        top = _trees(groups, ["some", "name"], ["name"], False).select(F.col("name").alias("grp"), F.col("proof").alias("up"), "root").alias("t")
        met = paths.alias("p").join(top, F.col("p.grp").eqNullSafe(F.col("t.grp")))
        uppers = met.select("p.part", "p.grp", "p.level", "p.idx", F.concat_ws("/", F.expr("nullif(p.path, '')"), F.expr("nullif(t.up, '')")).alias("path"), "p.subroot", "t.root")
    kinds = {f.name: f.dataType for f in placed.schema.fields}
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in carried]
    up = uppers.select("part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), "grp", "level", "idx", F.col("subroot").alias("digest"), "path", "root", *none)
    own = placed.select(part, F.lit(1).alias("kind"), "at", "grp", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("idx"), "digest", F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("root"), *carried)
    n = max(1, placed.rdd.getNumPartitions())
    both = up.unionByName(own).repartitionById(n, F.col("part")).sortWithinPartitions("part", "kind", "at")
    fields = [*(f"`{c}` {kinds[c].simpleString()}" for c in ["grp", *carried]), "leaf string", "proof string", "subroot string", "root string"]
    return both.transform(K.mapped, _handed(places, ["grp", *carried, "leaf", "proof", "subroot", "root"]), ", ".join(fields))


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id", carried: dict[str, Column] | None = None) -> DataFrame:
    """``order``, ``group``, leaf, proof, subroot, root and the carried columns (made from docs), one row for each of docs."""
    carried = carried or {}
    own = {f"c{k}": c for k, c in enumerate(carried.values())}
    leaves = docs.select(F.col(group).cast("string").alias("grp"), F.col(order).alias("id"), leaf(*(F.col(c) for c in columns)).alias("digest"), *(c.alias(k) for k, c in own.items()))
    made = _trees(stored(leaves, "leaves"), ["id"], ["id", *own], True)
    return made.select(F.col("id").alias(order), F.col("grp").alias(group), "leaf", "proof", "subroot", "root", *(F.col(k).alias(name) for k, name in zip(own, carried)))


def _fold(digest: str, proof: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [folded(d, p) for d, p in zip(K.column(batch, digest).to_pylist(), K.column(batch, proof).to_pylist())]
            roots, others = pa.array([r for r, _ in made], pa.string()), pa.array([sha256(o.encode()).hexdigest() for _, o in made], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, roots, others], names=[*batch.schema.names, "folded_root", "proof_sha256"])

    return run


def fold(proved: DataFrame, digest: str = "leaf", proof: str = "proof") -> DataFrame:
    """proved, the root that each digest gives with its proof as ``folded_root``, and H of the proof's digests as ``proof_sha256``."""
    return proved.transform(K.mapped, _fold(digest, proof), T.StructType([*proved.schema, T.StructField("folded_root", T.StringType()), T.StructField("proof_sha256", T.StringType())]))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op13."""
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampers, F.translate(F.col("text").cast("string"), "\n", "")).otherwise(F.col("text").cast("string"))
    tampered = leaf(*(F.col(c) for c in COLUMNS[:-1]), text)
    found = fold(manifest(docs, carried={"given": tampered}), "given")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
