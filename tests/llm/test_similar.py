"""Near-dedup of the pipeline against brute-force Jaccard similarity."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    texts = [None, "", "One two", "one  TWO", "one two three four five", "one two three four five six"]
    for size in (30, 120, 900):
        for changes in (1, 2, 4, 8, 12, 18, 25):
            base = text(size)
            own = list(base)
            for p in rng.sample(range(size), min(changes * size // 900 + 1, size)):
                own[p] = "changed"
            texts += [" ".join(base), " ".join(own), " ".join(base[: size - size // (changes + 3)])]
    chain = text(200)  # neighbours are similar, the ends are not
    texts += [" ".join(chain[k * 12 : k * 12 + 150]) for k in range(5)]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    rows += [rows[8], (None, texts[8], "en", "a", 0), (None, "alone without an id", "en", "a", 0)]
    rng.shuffle(rows)
    return rows


def test_near_dedup_covers_jaccard(spark):
    rows = corpus()
    group = brute.similar([r[1] for r in rows])
    least = {}
    for i, r in enumerate(rows):
        least[group[i]] = min(least.get(group[i], r), r, key=lambda x: brute.key(x[0]))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = corpus_pipeline.dedup_near(spark, docs, "")
    assert sorted((r["doc_id"] for r in kept.collect()), key=brute.key) == sorted((r[0] for r in least.values()), key=brute.key)
    assert kept.columns == docs.columns and corpus_pipeline.dedup_near(spark, docs.limit(0), "").count() == 0


def test_unlinked_texts_of_one_key_are_compared_without_pairs(spark, monkeypatch):
    """Texts at 0.7 of each other, a few at 0.8: all blocks of a key are compared, in whatever sizes."""
    from tidemark.llm import similar

    rng = random.Random(6)
    base = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(60):
        own = list(base)
        for p in rng.sample(range(400), 13 + k % 3):
            own[p] = f"x{k}_{p}"
        texts.append(" ".join(own))
    texts += [t + " and a few words" for t in texts[:5]]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    want = brute.similar(texts)
    monkeypatch.setattr(similar, "BLOCK", 7)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = {r["doc_id"] for r in similar.keep_one(docs).collect()}
    assert kept == {min(i for i, g in enumerate(want) if g == c) for c in set(want)} and 1 < len(kept) <= 60
