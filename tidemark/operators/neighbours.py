"""Approximate nearest neighbours: random hyperplanes deal points to cells, exact lists within cells, then neighbours of neighbours.

1. For each of ``tables`` tables a point's cell is the side on which it lies of some hyperplanes through the mean, as many as give cells of
   half of ``BLOCK`` points. Few dimensions have no room for so many cells about the mean: there a cell is a leaf of a tree of cuts, each in
   a random direction at the median of its points, of at most ``SAMPLE`` points that are sampled to place the cuts. Larger cells (copies of one vector, say) are cut by a hash of the id into blocks of about BLOCK points. A block is
   compared with itself in one matrix product; each point keeps its ``k`` best.
2. Rounds of neighbour descent (Dong et al., 2011): around each point its neighbours and up to 2k of the points that have it as
   neighbour meet, are compared with each other, and those better than what they have are merged in. Rounds end when under
   ``settled`` of all list entries change.

Up to BLOCK points the lists are exact. Work and shuffled bytes are in proportion to the points: no step makes all pairs of a cell larger than a
block. Distances are 1 - cosine over unit vectors (``cosine``) or Euclidean; equal distances go by id. Vectors are shuffled as they
came (floats take half the bytes of doubles) and brought to unit length, in doubles, where they meet.

Defined cases: points with a null vector are left out; the zero vector has distance 1 to all by cosine; a point is never its own
neighbour; repeated ids raise a ValueError; fewer than k other points: shorter lists; empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.operators import arrow
from tidemark.operators.vectors import unit
from tidemark.sources.durable import stored

#: Points that are compared with each other in one matrix product.
BLOCK = 1024
#: Points by which the cuts of trees are placed.
SAMPLE = 1 << 16
PAIRS = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("distance", pa.float64())])
DDL = "id long, other long, distance double"
METRICS = ("cosine", "euclidean")


def placed(column: pa.ChunkedArray | pa.Array, metric: str) -> np.ndarray:
    """Vectors as rows of doubles, of unit length for cosine."""
    return scaled(arrow.matrix(column), metric)


def scaled(x: np.ndarray, metric: str) -> np.ndarray:
    return x / np.maximum(np.sqrt(np.square(x).sum(axis=1)), 1e-12)[:, None] if metric == "cosine" else x


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return np.maximum(1 - a @ b.T, 0)
    return np.sqrt(np.maximum(np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


def least(d: np.ndarray, k: int) -> np.ndarray:
    """Where each row's k least finite values stand; of equal ones the first. Only rows with ties about the k-th value are sorted."""
    if d.shape[1] <= k:
        return np.isfinite(d)
    found = (d <= np.partition(d, k - 1, axis=1)[:, k - 1 : k]) & np.isfinite(d)
    for row in np.flatnonzero(found.sum(axis=1) > k):
        found[row, np.flatnonzero(found[row])[np.argsort(d[row, found[row]], kind="stable")[k:]]] = False
    return found


def _block(k: int, metric: str):
    def run(_: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, x = np.asarray(rows["id"]), placed(rows["x"], metric)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        for a in range(0, len(ids), BLOCK):  # a block may be somewhat larger than meant
            d = distances(x[a : a + BLOCK], x, metric)
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            row, column = np.nonzero(least(d, k))
            yield arrow.batch(PAIRS, ids[a + row], ids[column], d[row, column])

    return run


def _packed(points: DataFrame, kind: str) -> DataFrame:
    """Vectors as bytes, which pass between Spark and Python whole."""
    schema = pa.schema([("id", pa.int64()), ("x", pa.binary())])

    def run(batches: arrow.Batches) -> arrow.Batches:
        for rows in batches:
            yield arrow.batch(schema, rows.column("id"), [x.tobytes() for x in arrow.matrix(rows.column("x")).astype(kind)])

    return points.select("id", "x").mapInArrow(run, "id long, x binary")


def _around(k: int, metric: str, kind: str):
    """Points that meet around one: what each may gain, better than the worst that it has. Meetings of one size are compared together."""

    def run(starts: np.ndarray, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        x = np.frombuffer(b"".join(rows["x"].to_pylist()), kind).reshape(len(rows), -1)
        ids, x, worst = np.asarray(rows["id"]), scaled(x.astype(np.float64), metric), np.asarray(rows["worst"])
        size = np.diff(starts)
        for s in np.unique(size).tolist():
            at = starts[:-1][size == s][:, None] + np.arange(s)
            y = x[at]
            d = y @ y.transpose(0, 2, 1)
            if metric == "cosine":
                d = np.maximum(1 - d, 0)
            else:
                square = np.square(y).sum(axis=2)
                d = np.sqrt(np.maximum(square[:, :, None] + square[:, None, :] - 2 * d, 0))
            d[:, np.arange(s), np.arange(s)] = np.inf
            d = np.where(d <= worst[at][:, :, None], d, np.inf).reshape(-1, s)
            some = np.flatnonzero(np.isfinite(d).any(axis=1))
            d = d[some]
            many = np.isfinite(d).sum(axis=1) > k
            d[many] = np.where(least(d[many], k), d[many], np.inf)
            row, column = np.nonzero(np.isfinite(d))
            meeting = some[row] // s
            yield arrow.batch(PAIRS, ids[at[meeting, some[row] % s]], ids[at[meeting, column]], d[row, column])

    return run


def _top(pairs: DataFrame, k: int) -> DataFrame:
    near = pairs.groupBy("id", "other").agg(F.min("distance").alias("distance"))
    w = W.partitionBy("id").orderBy("distance", "other")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _sample(points: DataFrame, metric: str) -> np.ndarray:
    """Vectors of at most SAMPLE points by hash, to place cuts by; all points are dealt."""
    some = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").toArrow()
    return placed(some["x"], metric)


def _tree(x: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(direction, cut) of each node of a tree of so many levels: a node halves its own sampled points along a direction of its own."""
    direction = rng.standard_normal((2**bits - 1, x.shape[1]))
    cut, node = np.zeros(2**bits - 1), np.zeros(len(x), np.int64)
    for level in range(bits):
        along = (x * direction[node]).sum(axis=1)
        order = np.lexsort((along, node))
        first = np.searchsorted(node[order], np.arange(2**level - 1, 2 ** (level + 1)))
        for k, a, b in zip(range(2**level - 1, 2 ** (level + 1) - 1), first, first[1:]):
            cut[k] = np.median(along[order[a:b]]) if b > a else 0.0
        node = 2 * node + 1 + (along > cut[node])
    return direction, cut


def _leaf(x: np.ndarray, direction: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    while len(node) and node[0] < len(cut):
        node = 2 * node + 1 + ((x * direction[node]).sum(axis=1) > cut[node])
    return node


def _cells(points: DataFrame, tables: int, count: int, seed: int, metric: str) -> DataFrame:
    """(cell, id, x): every point in one block of each table."""
    some = points.select("x").first()
    width = len(some["x"]) if some else 0
    kind = dict(points.dtypes)["x"]
    x = F.col("x").cast("array<double>")
    sums = points.select(F.posexplode(unit(x) if metric == "cosine" else x).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).collect()
    mean = np.zeros(width)
    for r in sums:
        mean[r["i"]] = r["m"]
    bits = int(np.ceil(np.log2(2 * count / BLOCK))) if count > BLOCK else 0
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((tables, bits, width))
    trees = [_tree(x, bits, rng) for x in [_sample(points, metric)] * tables] if width < bits else []
    tables = tables if bits else 1
    schema = pa.schema([("cell", pa.int64()), ("id", pa.int64()), ("x", pa.list_(pa.float32() if kind == "array<float>" else pa.float64()))])

    def run(batches: arrow.Batches) -> arrow.Batches:
        for rows in batches:
            own = placed(rows.column("x"), metric)
            x = own - mean
            for t in range(tables):
                side = (x @ planes[t].T > 0).astype(np.int64) if bits else np.zeros((len(x), 0), np.int64)
                cell = (_leaf(own, *trees[t]) if trees else side @ (np.int64(1) << np.arange(bits, dtype=np.int64))) * tables + t
                yield arrow.batch(schema, cell, rows.column("id"), rows.column("x"))

    dealt = points.select("id", "x").mapInArrow(run, f"cell long, id long, x {kind}")
    if not bits:
        return dealt
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    cuts = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("long")
    return dealt.join(sizes, "cell", "left").select(F.xxhash64("cell", F.pmod(F.xxhash64("id", "cell"), cuts)).alias("cell"), "id", "x")


def neighbours(vectors: DataFrame, k: int = 15, key: str = "idx", vector: str = "vector", metric: str = "cosine", tables: int = 4, rounds: int = 8, settled: float = 0.002, seed: int = 42) -> DataFrame:
    """id, other, distance and rank (from 1): the lists of all points, stored."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    x = F.col(vector) if dict(vectors.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    points = stored(vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), x.alias("x")), "points", wide=True)
    count, ids = points.agg(F.count("*"), F.count_distinct("id")).first()
    if count != ids:
        raise ValueError(f"{count - ids} repeated ids")
    now = stored(_top(arrow.keyed(_cells(points, tables, count, seed, metric), "cell", _block(k, metric), DDL), k), "lists", wide=True)
    if count <= BLOCK:
        return now
    kind = "float32" if dict(points.dtypes)["x"] == "array<float>" else "float64"
    points = stored(_packed(points, kind), "packed", wide=True)
    for _ in range(rounds):
        back = W.partitionBy("other").orderBy(F.xxhash64("id", "other"))
        reverse = now.withColumn("n", F.row_number().over(back)).where(F.col("n") <= 2 * k).select(F.col("other").alias("at"), "id")
        meeting = now.select(F.col("id").alias("at"), F.col("other").alias("id")).unionByName(reverse).unionByName(points.select(F.col("id").alias("at"), "id")).distinct()
        worst = now.groupBy("id").agg(F.when(F.count("*") == k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("worst"))
        rows = meeting.join(points, "id").join(worst, "id", "left").select("at", "id", "x", F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
        gained = arrow.keyed_small(rows, "at", _around(k, metric, kind), DDL, "id")
        then = stored(_top(now.select("id", "other", "distance").unionByName(gained), k), "lists", wide=True)
        fresh = then.join(now, ["id", "other"], "left_anti").count()
        now = then
        if fresh <= settled * count * k:
            break
    return now
