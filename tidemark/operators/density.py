"""Density clustering of points by their neighbour lists: mutual reachability, spanning tree, condensed tree, stabilities.

The distance of two neighbours is their mutual reachability: the larger of their distance and both core distances (to the
``min_samples``-th neighbour). Edges are ordered by (distance, ids), so ties are decided alike everywhere.

Only edges of the minimum spanning tree count: tasks first drop those that close a cycle among the edges of one place (``thinned``), so
what goes on is little more than an edge a point.

1. Components smaller than ``min_cluster_size`` grow by their least outgoing edges, which belong to the minimum spanning tree
   (Boruvka). Two that choose the same edge merge, which is a merge of single linkage. One that reaches ``min_cluster_size``
   points is a leaf cluster and rests; what points to it, at however many removes, falls out of it at its own edge. So every
   point gets the edge at which it joins a cluster, in at most about min_cluster_size rounds over a shrinking edge table, of which
   the last ``FEW`` edges are taken in order by one task.
2. A spanning forest of the leaf clusters (Boruvka rounds while their edges are many) has the edges at which clusters merge. Lists seldom reach from one cluster
   to the next, so the points of leaf clusters (at most ``BRIDGE`` of each by hash, fewer where these are more than ``BRIDGES`` in
   all, which makes large tables approximate here) are compared across clusters in blocks, each of which leaves a spanning forest of
   its clusters; what stays apart splits at the root.
3. The cluster tree, at most 2 n / min_cluster_size nodes and checked against ``MOST_CLUSTERS``, is made on the driver from these edges, with
   each cluster's sum over points of 1 / distance. Excess of mass chooses the clusters; the root is never one.

Points never pass through the driver or one task. Weights below ``LEAST`` count as LEAST, so copies have a finite density.

Defined cases: fewer points than min_cluster_size, or no split below the root: all are outliers (-1); points without
neighbours are outliers; topics are numbered by size, largest first, then by least id; empty table: empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import arrow
from tidemark.operators.neighbours import distances
from tidemark.sources.durable import stored

LEAST = 1e-9
MOST_CLUSTERS = 1_000_000
#: Points of a cluster, and of all, that are compared to bridge unconnected parts.
BRIDGE, BRIDGES = 512, 1 << 16
BLOCK = 2048
#: Edges that one task takes in order where no more are left.
FEW = 1 << 18

Edge = tuple[float, int, int]


def reachability(lists: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(edges u < v with w, the mutual reachability; core distance of each id)."""
    core = lists.groupBy("id").agg(F.max(F.when(F.col("rank") <= min_samples, F.col("distance"))).alias("core"))
    other = core.select(F.col("id").alias("other"), F.col("core").alias("far"))
    both = lists.join(core, "id").join(other, "other")
    w = F.greatest("distance", "core", "far", F.lit(LEAST))
    return both.groupBy(F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v")).agg(F.min(w).alias("w")), core


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("w", pa.float64()), ("u", pa.int64()), ("v", pa.int64())])


def _end(up: list[int], x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _forest(batches: arrow.Batches) -> arrow.Batches:
    """The least spanning forest of a task's edges."""
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held)
    a, b, w, u, v = (np.asarray(rows[c]) for c in EDGES.names)
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    up, kept = list(range(len(names))), []
    order = np.lexsort((v, u, w))
    for k, x, y in zip(order.tolist(), ends[: len(a)][order].tolist(), ends[len(a) :][order].tolist()):
        x, y = _end(up, x), _end(up, y)
        if x != y:
            up[y] = x
            kept.append(k)
    yield arrow.batch(EDGES, *(x[kept] for x in (a, b, w, u, v)))


def thinned(edges: DataFrame, *near: str) -> DataFrame:
    """Edges a, b, e without those that are no part of the least spanning forest of some FEW edges; what they connect stays connected.

    The greatest edge of a cycle is in no least spanning forest, so clusters and their tree are the same. Tasks take edges in the order of
    the columns ``near``, by which edges between the same components should lie together.
    """
    tasks = -(-edges.count() // FEW)
    rows = edges.select("a", "b", "e.w", "e.u", "e.v", *near)
    rows = rows.repartitionByRange(tasks, *near, "a", "b") if tasks > 1 else rows.coalesce(1)
    kept = rows.select(*EDGES.names).mapInArrow(_forest, "a long, b long, w double, u long, v long")
    return kept.select("a", "b", F.struct("w", "u", "v").alias("e"))


def _parallel(edges: DataFrame) -> DataFrame:
    """The least edge between each two components; edges: a, b (components, a < b) and e (w, u, v)."""
    return edges.groupBy("a", "b").agg(F.min("e").alias("e"))


def _least(edges: DataFrame) -> DataFrame:
    """Each component's least edge e and the component t on its other side."""
    ends = edges.select(F.col("a").alias("c"), F.col("b").alias("t"), "e").unionByName(edges.select(F.col("b").alias("c"), F.col("a").alias("t"), "e"))
    return ends.groupBy("c").agg(F.min(F.struct("e", "t")).alias("x")).select("c", "x.t", "x.e")


def _jumped(pointers: DataFrame) -> DataFrame:
    """c, root: where pointers (c, t) end; a target that does not point, or points to itself, is an end."""
    now = stored(pointers, "pointers")
    while True:
        up = now.select(F.col("c").alias("t"), F.col("t").alias("further"))
        then = stored(now.join(up, "t", "left").select("c", F.coalesce("further", "t").alias("t")), "pointers")
        if then.join(now, ["c", "t"], "left_anti").isEmpty():
            return then.withColumnRenamed("t", "root")
        now = then


def _contracted(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges between components after these have moved to their roots."""
    a, b = roots.select(F.col("c").alias("a"), F.col("root").alias("ra")), roots.select(F.col("c").alias("b"), F.col("root").alias("rb"))
    moved = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"), "e").where("x <> y")
    return _parallel(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "e"))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select("a").union(edges.select(F.col("b").alias("a"))).distinct()


REST = pa.schema([("c", pa.int64()), ("root", pa.int64()), ("w", pa.float64()), ("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64()), ("step", pa.bool_())])


def _finished(min_cluster_size: int):
    """What the rounds would come to, by taking a task's worth of edges in order; rows of edges (e) and of small components (n)."""

    def run(batches: arrow.Batches) -> arrow.Batches:
        edges, size, up, froze, out = [], {}, {}, {}, []
        for rows in batches:
            for a, b, e, n in zip(*(rows.column(c).to_pylist() for c in ("a", "b", "e", "n"))):
                if e is None:
                    size[a] = n
                else:
                    edges.append(((e["w"], e["u"], e["v"]), a, b))

        def find(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        fell, between = {}, []
        for e, a, b in sorted(edges):
            a, b = sorted((find(a), find(b)))
            if a == b:
                continue
            small = [x for x in (a, b) if x in size and x not in froze]
            if not small:
                between.append((a, b, *e, None, False))
            elif len(small) == 1:
                up[small[0]], fell[small[0]] = b if small[0] == a else a, e
            else:
                up[b], size[a] = a, size[a] + size[b]
                if size[a] >= min_cluster_size:
                    froze[a] = e
        for x in size:
            y = x
            while y not in fell and up.get(y, y) != y and y not in froze:
                y = up[y]
            if y in froze and x == y:
                out.append((x, x, *froze[x], size[x], True))
            elif x != y:
                out.append((x, y, *(froze.get(y) or fell.get(y) or (None,) * 3), size[y], True))
            if x in fell:
                out.append((x, find(x), *fell[x], None, True))
        yield arrow.batch(REST, *zip(*out, *between)) if out or between else arrow.batch(REST, *[[]] * 7)

    return run


def leaf_clusters(ids: DataFrame, edges: DataFrame, min_cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """edges: a, b, e. (id, leaf, e: the cluster that each point joins and the edge at which it does, null for points that join none; edges between leaves)."""
    now = stored(edges, "edges", wide=True)
    small = ids.select(F.col("id").alias("c"), F.lit(1).cast("long").alias("n"))
    done, rounds, steps = F.col("n") >= min_cluster_size, 0, []
    while True:
        if now.count() <= FEW:
            none = F.lit(None).cast("struct<w:double,u:bigint,v:bigint>").alias("e")
            rows = now.withColumn("n", F.lit(None).cast("long")).unionByName(small.select(F.col("c").alias("a"), F.lit(None).cast("long").alias("b"), none, "n").join(_ends(now), "a", "left_semi"))
            rest = stored(rows.coalesce(1).mapInArrow(_finished(min_cluster_size), "c long, root long, w double, u long, v long, n long, step boolean"), "rest")
            steps.append(rest.where("step").select("c", "root", F.struct("w", "u", "v").alias("e"), "n"))
            now = _parallel(rest.where("not step").select(F.col("c").alias("a"), F.col("root").alias("b"), F.struct("w", "u", "v").alias("e")))
            break
        # small components point along their least edge; two that choose the same one merge, what points to a resting one falls to it
        least = stored(_least(now).join(small, "c"), "least")
        back = least.select(F.col("c").alias("t"), F.col("t").alias("c"), F.col("n").alias("m"))
        pairs = least.join(back, ["c", "t"]).where("c < t").select(F.col("t").alias("c"), F.col("c").alias("root"), "e", (F.col("n") + F.col("m")).alias("n"))
        ends = least.select("c", F.col("t").alias("root"), "e")
        if rounds > 2 * min_cluster_size:  # only long chains of small components are left by now: to their ends at once
            far = _jumped(least.join(pairs.select(F.col("root").alias("c")), "c", "left_anti").select("c", "t"))
            ends = least.select("c", "e").join(far, "c")
        fallen = ends.join(small.select(F.col("c").alias("root")), "root", "left_anti").select("c", "root", "e", F.lit(None).cast("long").alias("n"))
        step = stored(pairs.unionByName(fallen), "steps")
        if step.isEmpty():
            break
        steps.append(step)
        now = stored(_contracted(now, step.select("c", "root")), "edges", wide=True)
        grown = step.where("n is not null").select(F.col("root").alias("c"), "n")
        gone = step.select("c").unionByName(grown.select("c"))
        small, rounds = stored(small.join(gone, "c", "left_anti").unionByName(grown.where(~done)), "sizes"), rounds + 1
    if not steps:
        return ids.select("id", F.lit(None).cast("long").alias("leaf"), F.lit(None).cast("struct<w:double,u:long,v:long>").alias("e")), now
    all_ = steps[0]
    for x in steps[1:]:
        all_ = all_.unionByName(x)
    ends = _jumped(all_.where("n is not null and c <> root").select("c", F.col("root").alias("t")))
    own = ids.select(F.col("id").alias("c")).join(ends, "c", "left").select(F.col("c").alias("id"), F.coalesce("root", "c").alias("c"))
    joined = all_.where("n is null").select("c", F.col("root").alias("leaf"), "e").unionByName(all_.where(done).select(F.col("root").alias("c"), F.col("root").alias("leaf"), "e")).distinct()
    return stored(own.join(joined, "c", "left").select("id", "leaf", "e"), "joined", wide=True), now


def kruskal(edges: list[tuple[int, int, Edge]]) -> list[Edge]:
    """The minimum spanning forest of edges between components a and b."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    found = []
    for a, b, e in sorted(edges, key=lambda x: x[2]):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
            found.append(e)
    return found


def spanning(edges: DataFrame) -> list[Edge]:
    """:func:`kruskal` of edges a, b, e between at most MOST_CLUSTERS components; Boruvka rounds first leave one edge a component."""
    if edges.limit(MOST_CLUSTERS + 1).count() > MOST_CLUSTERS:
        now, found = edges, None
        while not now.isEmpty():
            least = stored(_least(now), "least")
            chosen = stored(least.select(F.least("c", "t").alias("a"), F.greatest("c", "t").alias("b"), "e").distinct(), "chosen")
            found = chosen if found is None else found.unionByName(chosen)
            back = least.select(F.col("c").alias("t"), F.col("t").alias("c"))
            rests = least.join(back, ["c", "t"]).where("c < t").select("c")
            now = stored(_contracted(now, _jumped(least.join(rests, "c", "left_anti").select("c", "t"))), "edges", wide=True)
        # an edge stands between the first components that it joined; its ends' own components are asked for by its points
        edges = found.join(edges.select("e", F.col("a").alias("x"), F.col("b").alias("y")), "e").select(F.col("x").alias("a"), F.col("y").alias("b"), "e")
    return kruskal([(r["a"], r["b"], tuple(r["e"])) for r in edges.collect()])


def between_parts(w: np.ndarray, u: np.ndarray, v: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """a, b, w, u, v: the least spanning forest of the parts p of the rows and q of the columns; w: distances.

    The ids u of rows and v of columns ascend, so the first of a row's or column's least distances is its least edge. Boruvka
    rounds halve the parts at least; a round looks at every distance at most twice.
    """
    names, of = np.unique(np.concatenate([p, q]), return_inverse=True)
    up, n, found = np.arange(len(names)), len(u), []
    across, down, stale, old = np.zeros(n, np.int64), np.zeros(len(v), np.int64), np.ones(n, bool), np.ones(len(v), bool)
    near, below = np.zeros(n), np.zeros(len(v))
    while True:
        a, b = up[of[:n]], up[of[n:]]
        if found:  # only what has come to lie within one component is looked for again
            stale, old = a == b[across], b == a[down]
        some = np.where(a[stale][:, None] == b[None, :], np.inf, w[stale])
        across[stale], near[stale] = some.argmin(axis=1), some.min(axis=1)
        some = np.where(b[old][:, None] == a[None, :], np.inf, w.T[old])
        down[old], below[old] = some.argmin(axis=1), some.min(axis=1)
        r, c, d = np.r_[np.arange(n), down], np.r_[across, np.arange(len(v))], np.r_[near, below]
        own = np.r_[a, b]
        low, high = np.minimum(u[r], v[c]), np.maximum(u[r], v[c])
        order = np.lexsort((high, low, d))
        order = order[np.isfinite(d[order])]
        if not len(order):
            break
        chosen = order[np.unique(own[order], return_index=True)[1]]
        _, first = np.unique(np.stack([low[chosen], high[chosen]]), axis=1, return_index=True)
        chosen = chosen[first]
        found.append((r[chosen], c[chosen], d[chosen]))
        ends = list(range(len(names)))
        for x, y in zip(a[r[chosen]].tolist(), b[c[chosen]].tolist()):
            x, y = _end(ends, x), _end(ends, y)
            ends[max(x, y)] = min(x, y)
        up = np.array([_end(ends, x) for x in range(len(ends))])[up]
    r, c, d = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return np.minimum(p[r], q[c]), np.maximum(p[r], q[c]), d, np.minimum(u[r], v[c]), np.maximum(u[r], v[c])


def _across(metric: str):
    """A block of points against another: the least spanning forest of their parts."""

    def run(_: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, part, core, side = (np.asarray(rows[c]) for c in ("id", "part", "core", "side"))
        x = arrow.matrix(rows["x"])
        order = np.argsort(ids, kind="stable")
        one = order[side[order] == 0]
        two = order[side[order] == 1] if (side == 1).any() else one
        w = np.maximum(np.maximum(distances(x[one], x[two], metric), np.maximum(core[one][:, None], core[two][None, :])), LEAST)
        yield arrow.batch(EDGES, *between_parts(w, ids[one], ids[two], part[one], part[two]))

    return run


def bridges(points: DataFrame, parts: DataFrame, metric: str) -> DataFrame | None:
    """a, b, e: edges that span parts as the least edges between them do; points: id, x, core; parts: id, part. None if one point of each is too many."""
    from pyspark.sql.window import Window as W

    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    total = lambda most: sizes.agg(F.sum(F.least("n", F.lit(most)))).first()[0] or 0
    most = BRIDGE
    while most > 1 and total(most) > BRIDGES:
        most //= 2
    if total(most) > BRIDGES:
        return None
    w = W.partitionBy("part").orderBy(F.xxhash64("id"), "id")
    some = parts.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most).drop("n").join(points, "id")
    some = stored(some.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(-(-total(most) // BLOCK)))), "bridges", wide=True)
    blocks = some.select("block").distinct()
    pairs = blocks.alias("a").join(blocks.alias("b"), F.col("a.block") <= F.col("b.block")).select(F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    sides = F.explode(F.array_distinct(F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), (F.col("i") != F.col("j")).cast("int").alias("side")))))
    dealt = pairs.select(F.xxhash64("i", "j").alias("pair"), sides.alias("s")).select("pair", "s.*").join(some, "block")
    found = arrow.keyed(dealt, "pair", _across(metric), "a long, b long, w double, u long, v long", even=True)
    return thinned(stored(_parallel(found.select("a", "b", F.struct("w", "u", "v").alias("e"))), "bridges"))


class Tree:
    """Clusters by single linkage over the leaf clusters: cluster k's parent, the edge at which it joins it, and whether it is chosen."""

    def __init__(self, leaves: list[int], edges: list[Edge], leaf_of: dict[int, int]) -> None:
        """edges: a spanning forest; leaf_of: the leaf of each edge's end."""
        self.number = {leaf: k for k, leaf in enumerate(sorted(leaves))}
        n = len(leaves)
        self.parent, self.birth = [-1] * n, [(np.inf, -1, -1)] * n
        self.children: dict[int, list[int]] = {}
        up, top = list(range(n)), list(range(n))

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        def join(parts: list[int], edge: Edge) -> int:
            k = len(self.parent)
            self.parent.append(-1)
            self.birth.append((np.inf, -1, -1))
            self.children[k] = parts
            for p in parts:
                self.parent[p], self.birth[p] = k, edge
            return k

        for edge in sorted(edges):
            a, b = (find(self.number[leaf_of[x]]) for x in edge[1:])
            up[b] = a
            top[a] = join([top[a], top[b]], edge)
        roots = sorted({top[find(x)] for x in range(n)})
        self.root = join(roots, (np.inf, -1, -1)) if len(roots) > 1 else roots[0] if roots else -1

    def fell_from(self, leaf: int, edge: Edge) -> int:
        """The cluster that a point of a leaf belongs to at its edge."""
        k = self.number[leaf]
        while k != self.root and self.birth[k] < edge:
            k = self.parent[k]
        return k

    def chosen(self, points: dict[int, tuple[int, float]]) -> dict[int, int]:
        """Of each cluster the chosen one at or above it, by excess of mass; points: number of points that fell from it, sum of 1 / w."""
        count, mass, best, pick = defaultdict(int), defaultdict(float), {}, {}
        for k in range(len(self.parent)):  # children come before parents
            own, rest = points.get(k, (0, 0.0)), self.children.get(k, [])
            split = self.birth[rest[0]][0] if rest else np.inf
            below = sum(count[c] for c in rest)
            count[k] = own[0] + below
            birth = 1 / self.birth[k][0]
            mass[k] = own[1] + below / split - count[k] * birth
            under = sum(best[c] for c in rest)
            pick[k] = k != self.root and (not rest or mass[k] >= under)
            best[k] = mass[k] if pick[k] else under
        out: dict[int, int] = {}
        for k in reversed(range(len(self.parent))):
            above = out.get(self.parent[k], -1)
            out[k] = above if above >= 0 else k if pick[k] else -1
        return out


def clusters(lists: DataFrame, points: DataFrame | None = None, min_cluster_size: int = 15, min_samples: int | None = None, metric: str = "euclidean") -> DataFrame:
    """id, topic (-1: outlier) of every id that has a list; lists: id, other, distance, rank; points: id, x, to bridge leaf clusters."""
    spark = lists.sparkSession
    edges, core = reachability(lists, min_samples or min_cluster_size)
    edges = edges.select(F.col("u").alias("a"), F.col("v").alias("b"), F.struct("w", "u", "v").alias("e"))
    if points is not None:  # edges of one place together
        edges = edges.join(points.select(F.col("id").alias("a"), F.col("x")[0].alias("near")), "a", "left")
        edges = thinned(stored(edges, "reachable", wide=True), "near")
    ids = stored(lists.select("id").union(lists.select(F.col("other").alias("id"))).distinct(), "ids")
    joined, between = leaf_clusters(ids, edges, min_cluster_size)
    leaves = [r["leaf"] for r in joined.where("leaf is not null").select("leaf").distinct().limit(MOST_CLUSTERS + 1).collect()]
    if len(leaves) > MOST_CLUSTERS:
        raise ValueError(f"more than {MOST_CLUSTERS} clusters of {min_cluster_size} points: ask for larger ones")
    if points is not None and len(leaves) > 1:
        more = bridges(points.join(core, "id").select("id", "x", "core"), joined.where("leaf is not null").select("id", F.col("leaf").alias("part")), metric)
        between = between if more is None else stored(_parallel(between.unionByName(more)), "between")
    tree_edges = spanning(between)
    asked = spark.createDataFrame([(x,) for x in sorted({x for e in tree_edges for x in e[1:]})], "id long")
    tree = Tree(leaves, tree_edges, {r["id"]: r["leaf"] for r in joined.join(asked, "id").collect()})
    schema = pa.schema([("id", pa.int64()), ("k", pa.int32()), ("density", pa.float64())])

    def fell(batches: arrow.Batches) -> arrow.Batches:
        for rows in batches:
            e = rows.column("e").to_pylist()
            k = [tree.root if leaf is None else tree.fell_from(leaf, (x["w"], x["u"], x["v"])) for leaf, x in zip(rows.column("leaf").to_pylist(), e)]
            yield arrow.batch(schema, rows.column("id"), k, [0.0 if x is None else 1 / x["w"] for x in e])

    placed = stored(joined.mapInArrow(fell, "id long, k int, density double"), "placed", wide=True)
    sums = {r["k"]: (r["n"], r["s"]) for r in placed.groupBy("k").agg(F.count("*").alias("n"), F.sum("density").alias("s")).collect()}
    of = tree.chosen(sums)
    topic = spark.createDataFrame(list(of.items()) or [(-1, -1)], "k int, topic int")
    named = stored(placed.join(topic, "k", "left").select("id", F.coalesce("topic", F.lit(-1)).alias("topic")), "topics", wide=True)
    order = named.where("topic >= 0").groupBy("topic").agg(F.count("*").alias("n"), F.min("id").alias("first")).orderBy(F.desc("n"), "first").collect()
    new = spark.createDataFrame([(r["topic"], k) for k, r in enumerate(order)] or [(-2, -2)], "topic int, new int")
    return named.join(new, "topic", "left").select("id", F.coalesce("new", F.lit(-1)).alias("topic"))
