"""What must not grow with the square of the input or gather in one place: pairs of line dedup, slices and passed anchors of the sketch."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import kernels as K
from tidemark.llm import line_dedup, sketch, substrings

U64 = np.uint64


def redesigned(n):
    """Two shared lines that swap places half way, among lines of each document's own."""
    rng = random.Random(4)
    own = lambda: f"own {rng.random()}"
    return [(i, "\n".join([own(), *(x for y in (["menu of the site"], [own()], ["all rights reserved"])[:: 1 if i < n // 2 else -1] for x in y), own()])) for i in range(n)]


def test_pairs_of_a_redesigned_template_grow_with_the_documents(spark, monkeypatch):
    made, plain = [], line_dedup.stored

    def counted(df, name, wide=False):
        out = plain(df, name, wide)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    total = []
    for n in (60, 120):
        made.clear()
        rows = redesigned(n)
        got = {r["doc_id"]: r["n_removed"] for r in line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {r[0]: r[3] for r in brute.line_dedup(rows, every_pair=True)} if n == 60 else sum(got.values()) > n
        total.append(sum(made))
    assert total[1] <= 2.2 * total[0] and total[1] <= 12 * 120


@pytest.mark.parametrize("slices", [1, 8, 64])
def test_the_sketch_drops_unique_anchors(slices):
    """At the load that build() aims at: six cells a row for each anchor."""
    rng = np.random.default_rng(1)
    n = slices * (1 << sketch.ROW_BITS) // 6
    h = rng.integers(0, 1 << 63, (n, 35), dtype=np.uint64).min(axis=1)  # least hashes of windows of 35 grams
    at, cells = sketch.place(h, slices)
    share = np.bincount(at, minlength=slices) / n * slices
    assert share.max() < 1.1
    passed = np.ones(n, bool)
    for c in cells:
        key = at * sketch.SLICE + c
        count = np.bincount(key, minlength=slices * sketch.SLICE)
        passed &= count[key] > 1
    assert passed.mean() < 0.05


def test_a_passage_of_a_third_of_all_documents_is_spread_over_salts(spark):
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(i, passage if i % 3 == 0 else " ".join(f"w{i}_{k}" for k in range(80))) for i in range(90)]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert got == {i: 80 if i % 3 == 0 and i else 0 for i in range(90)}
    assert len(K.mix(np.arange(4, dtype=U64))) == 4 and sketch.SALTS > 1
