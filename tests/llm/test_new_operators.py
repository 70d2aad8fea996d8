"""Merkle manifest, vector codes and n-gram join against brute force, with nulls, ties, repeats, long texts, clashing columns and hot groups."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import merkle, ngram_join, vector_codes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, part int, grp string, node bigint, key string, n int"
EXTRA = ("x", 1, "g", 2, "k", 3)


def same(df, expected):
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(expected, key=repr)


# Merkle manifest


def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: h(*map(part, r))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
        return levels

    def siblings(levels, k):
        for level in levels[:-1]:
            lo = k // 3 * 3
            yield k - lo, [x for j, x in enumerate(level[lo : lo + 3], lo) if j != k]
            k //= 3

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ranked = {s: sorted(groups[s], key=lambda x: x[:3]) for s in order}
    trees = {s: tree([x[2] for x in ranked[s]]) for s in order}
    over = tree([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for k, (_, _, own, r) in enumerate(ranked[s]):
            path = [*siblings(trees[s], k), *siblings(over, i)]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                r = (*r[:4], r[4] and r[4].replace("\n", ""))
            d = leaf(r)
            for place, others in path:
                d = h(*others[:place], d, *others[place:])
            out.append((r[0], own, trees[s][-1][0], over[-1][0], h(*(x for _, o in path for x in o)), d, d == over[-1][0]))
    return out


def merkle_rows():
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", "x\ny", "line\n\nz é", "long " * 3000]), rng.choice(["en", None]), rng.choice(["a", "b", "é", None, "hot", "hot", "hot"]), rng.choice([None, 5])) for i in range(400)]
    return [*rows, *rows[:9], *[(None, "t\n", "en", "a", 1)] * 3, (5, "other", "en", "hot", 1), (1000, "q\n", "x", "solo", 0)]


@pytest.mark.parametrize("leaves, few, span", [(1 << 16, 1000, 5), (40, 10, 1), (17, 5, 2)])
def test_manifest_and_proofs(spark, monkeypatch, leaves, few, span):
    """One partition, and many with ragged edges over several rounds."""
    for name, value in (("LEAVES", leaves), ("FEW", few), ("SPAN", span)):
        monkeypatch.setattr(merkle, name, value)
    rows = merkle_rows()
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)
    same(merkle.digest(docs), plain_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in rows]))


def test_manifest_edges(spark):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in merkle_rows()], SCHEMA)
    assert merkle.digest(docs.limit(0)).count() == 0
    one = docs.where("doc_id = 1000")
    (row,) = merkle.manifest(one).collect()
    assert row["proof"] == "" and row["leaf"] == row["subroot"] == row["root"]
    every = [(i, f"t{i}\n", None, f"s{i}", None) for i in range(30)]  # as many groups as rows
    same(merkle.digest(spark.createDataFrame([(*r, *EXTRA) for r in every], SCHEMA)), plain_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in every]))


def test_proofs_are_found_wrong_after_a_change(spark):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in merkle_rows()], SCHEMA)
    proved = merkle.fold(merkle.manifest(docs))
    assert proved.where("folded_root <> root").count() == 0
    assert merkle.folded("0" * 64, proved.first()["proof"])[0] != proved.first()["root"]


# Vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(k, lab, [int(np.floor(1024 * float(x))) for x in v]) for k, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[2], p) for r in order[:entries]] for p in range(parts)]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, book: min(range(len(book)), key=lambda e: (d2(v, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for r in kept:
                own.setdefault(near(cut(r[2], p), books[p]), []).append(cut(r[2], p))
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else b for e, b in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], {}
    for k, lab, v in kept:
        code = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d2(cut(v, p), books[p][c]) for p, c in enumerate(code))
        out.append((k, "".join(f"{c:02x}" for c in code), error, lab))
        total[lab] = total.get(lab, 0) + error
    return [(k, code, error, total[lab], digest) for k, code, error, lab in out]


def vector_rows(n=420):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8).round(3)], int(rng.integers(0, 4)) if i % 7 else None) for i in rng.permutation(n)]
    rows += [(n + i, rows[0][1], 1) for i in range(n // 3)]  # a third are copies
    rows += [(3, [0.5] * 8, 2), (3, [0.5] * 8, 2), (None, [0.1] * 8, 1), (7000, None, 1), (7001, [float("nan")] * 8, 1), (7002, [None] * 8, 1), (7003, [float("inf")] * 8, 0)]
    return rows


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("entries", [256, 16])
def test_codes(spark, entries):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    coded, books = vector_codes.compress(df, entries=entries)
    want = plain_codes(rows, entries=entries)
    same(coded.select("vec_id", "code", "error"), [r[:3] for r in want])
    assert vector_codes.books_hash(books) == want[0][4]
    if entries == 256:
        from pyspark.sql import functions as F

        same(vector_codes.digest(df.withColumn("code", F.lit("x")).withColumn("kind", F.lit(9))), want)


def test_bounds_save_most_scans_and_never_decide_a_tie():
    """After the first round bounds leave few rows to compare with all entries; ties stay with the lower entry."""
    rng = np.random.default_rng(1)
    x = (rng.integers(0, 12, 3000) * 400)[:, None] + rng.integers(-30, 30, (3000, 4))
    book = x[:64].copy()
    code, upper, lower = vector_codes.scanned(x, book)
    for _ in range(4):
        moved = book.copy()
        for e in np.unique(code):
            moved[e] = x[code == e].sum(axis=0) // (code == e).sum()
        code, upper, lower, seen = vector_codes.reassigned(x, moved, vector_codes.Move(book, moved), code, upper, lower)
        book = moved
        assert (code == np.square(x[:, None] - book[None]).sum(-1).argmin(1)).all()
    assert seen < 0.7 * len(x)
    tie = np.array([[0], [10], [5]])
    code, upper, lower = vector_codes.scanned(tie, np.array([[0], [10], [0]]))
    assert code.tolist() == [0, 1, 0] and not (upper[2] < lower[2])


def test_vector_edges(spark):
    df = spark.createDataFrame(vector_rows(), VECTORS)
    assert vector_codes.digest(df.limit(0)).count() == 0 and vector_codes.digest(df.where("vec_id > 7000")).count() == 0
    one = vector_codes.digest(df.where("vec_id = 5")).collect()
    assert [(r["code"], r["error"]) for r in one] == [("00000000", 0)]
    with pytest.raises(ValueError):
        vector_codes.integers(__import__("pyarrow").array([[1.0] * 8, [1.0] * 4]), 4)
    with pytest.raises(ValueError):
        vector_codes.integers(__import__("pyarrow").array([[1.0] * 6]), 4)
    with pytest.raises(OverflowError):
        vector_codes.integers(__import__("pyarrow").array([[1e30] * 4]), 4)
    big = np.array([[1 << 26] * 4, [-(1 << 26)] * 4])
    assert not vector_codes.fits(big, big) and vector_codes.distances(big, big)[0, 1] == 4 * (1 << 27) ** 2


# N-gram join


def plain_join(rows, percent=90, shingle=3):
    sets = []
    for _, t in rows:
        w = brute.SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


def join_rows():
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randint(0, 4000)}" for _ in range(n)]
    texts = [None, "", " \n ", "One two", "one  TWO", "one two three", "a b c d"]
    for size in (11, 14, 30, 60, 150, 400, 1200):
        for changes in (0, 1, 2, 3, 5, 8, 13, 20):
            base = words(size)
            own = list(base)
            for p in rng.sample(range(size), min(size, changes * size // 600 + (changes > 0))):
                own[p] = "changed"
            texts += [" ".join(base), " ".join(own), " ".join(base[: size - changes * size // 200])]
    chain = words(300)  # neighbours link, the ends do not
    texts += [" ".join(chain[k * 6 : k * 6 + 220]) for k in range(8)]
    passage = words(80)  # shared by many without making them alike
    texts += [" ".join(words(30) + passage) for _ in range(25)]
    hot = words(200)  # a large group of near copies, of which some link and some are just too far
    for k in range(70):
        own = list(hot)
        for p in rng.sample(range(200), k % 9):
            own[p] = f"x{k}_{p}"
        texts.append(" ".join(own))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, texts[20]), (None, "alone without an id at all here"), (20, "one id with another text of its own")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, percent", [(512, 90), (8, 90), (8, 80)])
def test_join(spark, monkeypatch, block, percent):
    """Whole trees, and groups cut into blocks by node and by component."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = join_rows()
    docs = spark.createDataFrame([(d, t, "en", "a", 0, *EXTRA) for d, t in rows], SCHEMA).repartition(4)
    want = plain_join(rows, percent)
    same(ngram_join.classes(docs, percent=percent).select("doc_id", "n_shingles", "component_id"), want)
    assert len({c for _, _, c in want}) < len(rows) - 60


def test_join_of_an_empty_table(spark):
    assert ngram_join.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    same(ngram_join.digest(only), [(1, 0, 1), (2, 0, 2)])


def test_linked_sets_share_a_key_and_trees_find_what_pairs_do():
    rng = np.random.default_rng(2)
    missed = 0
    for n in [9, 10, 12, 17, 18, 19, 26, 27, 28, 40, 41, 93, 200, 500] * 12:
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for gone in range(0, n // 9):
            b = np.concatenate((a[gone:], rng.integers(0, 1 << 63, rng.integers(0, gone + 2), dtype=np.uint64)))
            both = n - gone
            if 100 * both >= 90 * (n + len(b) - both) and 0 < len(b):
                h_, at = np.concatenate((np.sort(a), np.sort(b))), np.array([0, n, n + len(b)])
                one, two = ngram_join.keys_of(h_, at, 90)
                missed += len(np.intersect1d(one, two)) == 0 and set(a) != set(b)
    assert missed == 0
    for case in range(30):
        base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        sets = [np.unique(np.where(rng.random(60) < case / 300, rng.integers(0, 1 << 63, 60, dtype=np.uint64), base))[: rng.integers(50, 61)] for _ in range(80)]
        side = rng.integers(0, 2, 80) if case % 2 else np.zeros(80, np.int64)
        found = ngram_join.linked(sets, np.arange(80), side, 90)
        links = {(i, j) for i in range(80) for j in range(i) if side[i] != side[j] or not case % 2 if 190 * len(np.intersect1d(sets[i], sets[j])) >= 90 * (len(sets[i]) + len(sets[j]))}
        assert all((max(p), min(p)) in links for p in found)

        def groups(pairs):
            up = list(range(80))
            for a, b in pairs:
                x, y = up[a], up[b]
                up = [x if u == y else u for u in up]
            return [up.index(u) for u in up]

        assert groups(found) == groups(links)
