"""Topic fitting: neighbour lists against brute force, clusters against plain single linkage, layout and fit on planted groups."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import density, layout, neighbours
from tidemark.operators.topics import DensityFitter
from tidemark.operators.vectors import unit


def frame(spark, x, start=0):
    return spark.createDataFrame([(start + i, [float(v) for v in p]) for i, p in enumerate(x)], "idx long, vector array<double>").repartition(3)


def planted(n=60, width=16, groups=6, seed=5):
    rng = np.random.default_rng(seed)
    of = np.repeat(np.arange(groups), n)
    inner = rng.normal(0, 1, (groups, 4))[of] + rng.normal(0, 0.15, (len(of), 4))
    return inner @ rng.normal(0, 1, (4, width)) + rng.normal(0, 0.05, (len(of), width)), of


def plain_clusters(x, m, samples):
    """Kruskal over all mutual reachabilities, the tree condensed from its root down, excess of mass."""
    n = len(x)
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(-1))
    core = np.sort(d + np.where(np.eye(n) > 0, np.inf, 0), axis=1)[:, samples - 1]
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    up, top, size, kids, weight = list(range(n)), list(range(n)), [1] * n, {}, {}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for e in sorted((max(w[i, j], density.LEAST), i, j) for i in range(n) for j in range(i + 1, n)):
        a, b = find(e[1]), find(e[2])
        if a != b:
            k = len(size)
            size.append(size[top[a]] + size[top[b]])
            kids[k], weight[k] = (top[a], top[b]), e[0]
            up[b], top[a] = a, k
    points = lambda k: [k] if k not in kids else [p for q in kids[k] for p in points(q)]
    found = []

    def walk(k, birth, parent):
        c = len(found)
        found.append({"birth": birth, "parent": parent, "fell": [], "kids": []})
        while True:
            a, b = kids[k]
            at, big = 1 / weight[k], [q for q in (a, b) if size[q] >= m]
            if len(big) == 2:
                found[c]["kids"] = [(walk(q, at, c), at, size[q]) for q in (a, b)]
                return c
            for q in {a, b} - set(big):
                found[c]["fell"] += [(p, at) for p in points(q)]
            if not big:
                return c
            k = big[0]

    walk(len(size) - 1, 0.0, -1)
    best, pick, topic = {}, {}, np.full(n, -1)
    for k in reversed(range(len(found))):
        c = found[k]
        mass = sum(at - c["birth"] for _, at in c["fell"]) + sum(s * (at - c["birth"]) for _, at, s in c["kids"])
        under = sum(best[q] for q, _, _ in c["kids"])
        pick[k] = k != 0 and (not c["kids"] or mass >= under)
        best[k] = mass if pick[k] else under
    for k, c in enumerate(found):
        q, chosen = k, -1
        while q != -1:
            chosen, q = (q if pick[q] else chosen), found[q]["parent"]
        for p, _ in c["fell"]:
            topic[p] = chosen
    return topic.tolist()


def alike(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b)) and all((x < 0) == (y < 0) for x, y in zip(a, b))


def scattered(case):
    rng = np.random.default_rng(case)
    groups = [rng.normal(0, s, (c, 2)) + rng.uniform(-9, 9, 2) for s, c in ((0.4, 40), (0.8, 50), (0.3, 30), (1.2, 45))]
    return np.concatenate([*groups, rng.uniform(-10, 10, (25, 2)), np.zeros((4, 2))])


@pytest.mark.parametrize("case, k, few", [(3, 1000, 1 << 18), (4, 30, 1 << 18), (5, 30, 300)])
def test_clusters_equal_plain_single_linkage(spark, monkeypatch, case, k, few):
    """Complete and short neighbour lists; the last edges in one task, or rounds until few are left."""
    monkeypatch.setattr(density, "FEW", few)
    x = scattered(case)
    df = frame(spark, x)
    lists = neighbours.neighbours(df, min(k, len(x) - 1), metric="euclidean")
    got = {r["id"]: r["topic"] for r in density.clusters(lists, df.select(F.col("idx").alias("id"), F.col("vector").alias("x"))).collect()}
    want = plain_clusters(x, 15, 15)
    assert len(set(want)) > 3 and alike([got[i] for i in range(len(x))], want)


def test_many_edges_are_spanned_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(a, b, (float(rng.integers(1, 9)), a, b)) for a in range(40) for b in range(a + 1, 40) if rng.random() < 0.3]
    edges = spark.createDataFrame(rows, "a long, b long, e struct<w:double,u:long,v:long>")
    want = density.kruskal(rows)
    monkeypatch.setattr(density, "MOST_CLUSTERS", 50)
    assert sorted(density.spanning(edges)) == sorted(want) and len(want) == 39


def test_neighbours_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    x, _ = planted(n=80)
    x = np.concatenate([x, np.repeat(x[:1], 150, axis=0)])  # a vector of which a fifth are copies
    df = frame(spark, x).unionByName(spark.createDataFrame([(9999, None)], "idx long, vector array<double>"))
    got = {}
    for r in neighbours.neighbours(df, 10).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["distance"])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    d = np.sort(1 - u @ u.T + np.where(np.eye(len(u)) > 0, 9, 0), axis=1)[:, :10]
    assert set(got) == set(range(len(x)))
    assert np.mean([np.mean(np.array(got[i]) <= d[i, -1] + 1e-9) for i in range(len(x))]) >= 0.9
    with pytest.raises(ValueError):
        neighbours.neighbours(df.unionByName(df), 10)
    assert neighbours.neighbours(df.limit(0), 10).count() == 0


def trustworthiness(d, y, k):
    n = len(y)
    e = np.square(y[:, None] - y[None]).sum(-1) + np.where(np.eye(n) > 0, np.inf, 0)
    rank = np.argsort(np.argsort(d + np.where(np.eye(n) > 0, np.inf, 0), axis=1), axis=1) + 1
    r = np.take_along_axis(rank, np.argsort(e, axis=1)[:, :k], axis=1)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(r - k, 0).sum()


def test_layout_keeps_neighbourhoods_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(layout, "BLOCK", 150)  # several blocks
    x, _ = planted()
    df = frame(spark, x)
    points = df.select(F.col("idx").alias("id"), unit(F.col("vector")).alias("x"))
    lists = neighbours.neighbours(df, 15)
    one, two = ({r["id"]: r["y"] for r in layout.layout(lists, points).collect()} for _ in range(2))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert one == two and trustworthiness(1 - u @ u.T, np.array([one[i] for i in range(len(x))]), 15) > 0.95


def test_fit_finds_planted_topics(spark):
    x, of = planted(n=50, groups=5)
    found = {r["idx"]: r["topic"] for r in DensityFitter().fit(frame(spark, x, 100).unionByName(spark.createDataFrame([(7, None)], "idx long, vector array<double>"))).collect()}
    assert len(found) == len(x) + 1 and found[7] == -1
    kept = [(found[100 + i], g) for i, g in enumerate(of.tolist()) if found[100 + i] >= 0]
    assert len(kept) > 0.9 * len(x) and len({t for t, _ in kept}) == 5 and len(set(kept)) == 5


def test_too_few_points_are_outliers(spark):
    assert {r["topic"] for r in DensityFitter().fit(frame(spark, np.eye(4))).collect()} == {-1}
    assert DensityFitter().fit(frame(spark, np.eye(4)).limit(0)).count() == 0


@pytest.mark.parametrize("case", [0, 1])
def test_blocks_leave_a_spanning_forest_of_their_parts(case):
    """A block of points of many parts leaves at most an edge a part, and what Kruskal takes of all pairs, ties among them."""
    rng = np.random.default_rng(case)
    u, v = np.sort(rng.permutation(200)[:120].reshape(2, 60), axis=1)
    v = u if case else v
    part = rng.integers(0, 30, 200)
    w = np.round(rng.random((60, 60)), 1) + 0.1
    w = np.maximum(w, w.T) if case else w
    got = density.between_parts(w.copy(), u, v, part[u], part[v])
    pairs = [(int(part[a]), int(part[b]), (float(w[i, j]), int(min(a, b)), int(max(a, b)))) for i, a in enumerate(u) for j, b in enumerate(v) if part[a] != part[b]]
    assert sorted(zip(*(x.tolist() for x in got[2:]))) == sorted(density.kruskal(pairs)) and len(got[0]) < 30
    assert all({int(part[a]), int(part[b])} == {p, q} for p, q, a, b in zip(*(x.tolist() for x in (got[0], got[1], got[3], got[4]))))


def test_edges_that_close_cycles_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(density, "FEW", 100)
    rng = np.random.default_rng(4)
    rows = [(a, b, (float(rng.integers(1, 9)), a, b), a // 10) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.5]
    kept = density.thinned(spark.createDataFrame(rows, "a long, b long, e struct<w:double,u:long,v:long>, near int"), "near").collect()
    assert len(kept) < len(rows) * 0.7 and density.kruskal([(r["a"], r["b"], tuple(r["e"])) for r in kept]) == density.kruskal([r[:3] for r in rows])


def test_cells_of_flat_points_do_not_grow(spark):
    """Hyperplanes through the mean cut a plane into few wedges; so lists of flat points had to be mended over many rounds."""
    x = np.random.default_rng(1).normal(0, 1, (6000, 2))
    points = frame(spark, x).select(F.col("idx").alias("id"), F.col("vector").alias("x"))
    cells = neighbours._cells(points, 1, len(x), 42, "euclidean").groupBy("cell").agg(F.count("*").alias("n"), F.stddev(F.col("x")[0]).alias("s"), F.stddev(F.col("x")[1]).alias("t")).collect()
    assert sum(r["n"] for r in cells) == len(x) and max(r["n"] for r in cells) < 700
    assert np.mean([r["s"] * r["t"] for r in cells]) < 0.15


def test_lists_of_less_than_a_block_are_exact(spark):
    x = np.random.default_rng(2).normal(0, 1, (700, 8))
    got = {}
    for r in neighbours.neighbours(frame(spark, x), 5, metric="euclidean").collect():
        got.setdefault(r["id"], []).append(r["other"])
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(-1)) + np.where(np.eye(len(x)) > 0, np.inf, 0)
    assert all(set(got[i]) == set(np.argsort(d[i])[:5].tolist()) for i in range(len(x)))


def test_memberships_of_a_list_sum_to_its_target():
    d = np.random.default_rng(3).random((50, 15))
    d[0], d[1, :14] = 0.0, 0.0
    w = layout._memberships(np.sort(d, axis=1))
    assert np.allclose(w[2:].sum(axis=1), np.log2(15), atol=1e-5) and (w[0] == 1).all()
