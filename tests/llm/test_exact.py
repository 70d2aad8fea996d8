"""Operators with one right answer, against brute force on a fixture with nulls, ties, repeats, long texts and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import components, decontaminate, line_dedup, mixing, outliers, simhash, substrings, suffixes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp string, h bigint, n_words string, ord int, uid int, bucket string"


def corpus() -> list[tuple]:
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join(word() for _ in range(70))
    shared = [line(12) for _ in range(6)]
    texts: list[str | None] = [None, "", "   \n\t ", "one", "the the the the", passage, f"{line(9)}\n{passage}\n{line(9)}", passage + " tail", "x " + passage.upper()]
    base = "\n".join(line(12) for _ in range(8))
    for k in range(12):  # near copies: one line of a text differs
        own = base.split("\n")
        own[k % 8] = line(12)
        texts.append("\n".join(own))
    texts += [base] * 5 + ["\n".join(rng.sample(shared, 4) + [line(10)]) for _ in range(8)]
    texts += [" ".join(word() for _ in range(3000)), ("abc " * 700).strip(), "a" * 1500, "\n".join([shared[0]] * 5)]
    texts += [" ".join(word() for _ in range(rng.randint(3, 120))) for _ in range(20)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "B", "ç", None]), 0, 0.5, "x", 1, "y", 1, 2, "z") for i, t in enumerate(texts)]
    rows += [rows[5], rows[30], (None, base, "en", None, 0, 0.1, "x", 1, "y", 1, 2, "z"), (None, passage, None, "a", 0, 0.1, "x", 1, "y", 1, 2, "z"), (7, "other text with id seven", "en", "a", 0, 0.0, "x", 1, "y", 1, 2, "z")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def same(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(expected, key=repr)


def test_decontaminate(spark, docs, rows, empty):
    texts = {r[0]: r[1] for r in rows}
    items = [(1, texts[5]), (2, "The THE, the"), (3, None), (4, "..."), (2, "one"), (None, "tail"), (11, texts[6]), (1, texts[5])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = brute.contamination([r[:2] for r in rows], items)
    same(decontaminate.digest(docs, bench), want)
    assert decontaminate.digest(empty, bench).count() == 0
    assert decontaminate.digest(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    wide = decontaminate.contamination(docs, bench)
    assert {"score", "hit_items", "n_hit"} <= set(wide.columns) and wide.count() == len(rows)


def test_texts_with_one_key_keep_their_own_findings(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "text_keys", lambda text: (F.length(text) % 2, F.xxhash64(F.lit(2), text)))
    items = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    items = [(x["item_id"], x["text"]) for x in items] + [(f"own-{r[0]}", " ".join((r[1] or "").split()[:20])) for r in rows[:6]]
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = brute.contamination([r[:2] for r in rows], items)
    assert sum(x[2] > 0 for x in want) >= 4
    same(decontaminate.digest(docs, bench), want)


def test_decontaminate_scans_do_not_grow_with_the_benchmark(spark, docs, rows, monkeypatch):
    """A larger benchmark, and sieves too small for it: the same plan, the same exact result."""
    texts = {r[0]: r[1] for r in rows}
    small = [(1, texts[5])]
    large = [(k, t) for k, t in enumerate(texts.values())] * 2
    scans = []
    mapped = decontaminate.K.mapped
    monkeypatch.setattr(decontaminate.K, "mapped", lambda df, run, schema: scans.append(run.__qualname__) or mapped(df, run, schema))
    monkeypatch.setattr(decontaminate, "MAX_BITS", 6)
    for items in (small, large):
        same(decontaminate.digest(docs, spark.createDataFrame(items, "item_id int, text string")), brute.contamination([r[:2] for r in rows], items))
    assert len(scans) == 10 and scans[:5] == scans[5:]


def test_substrings(docs, rows, empty):
    for window in (50, 5):
        same(substrings.dedup(docs, window=window).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)), brute.substrings([r[:2] for r in rows], window))
    assert substrings.digest(empty).count() == 0


def test_suffixes(docs, rows, empty):
    for length in (400, 30):
        same(suffixes.dedup(docs, length=length).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)), brute.suffixes([r[:2] for r in rows], length))
    assert suffixes.digest(empty).count() == 0


def test_sketch_of_many_slices(docs, rows, monkeypatch):
    """Small slices and buckets: many of each, as a large input has them."""
    from tidemark.llm import packed, sketch

    build = sketch.build
    monkeypatch.setattr(sketch, "build", lambda texts, anchors, gap: build(texts, anchors, gap / 4000))
    monkeypatch.setattr(packed, "BUCKET_BYTES", 500)
    same(substrings.dedup(docs, window=5).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)), brute.substrings([r[:2] for r in rows], 5))
    same(suffixes.dedup(docs, length=30).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)), brute.suffixes([r[:2] for r in rows], 30))


def test_batches_are_bounded(spark):
    from tidemark.llm import kernels

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for given, kept in (("64m", str(kernels.BATCH_BYTES)), ("1MB", "1MB"), ("4194304b", "4194304b"), ("9000000", str(kernels.BATCH_BYTES))):
        spark.conf.set(name, given)
        kernels.mapped(spark.range(1), lambda batches: batches, "id long")
        assert spark.conf.get(name) == kept
    keys = [[1, 1, 2], [2, 2], [], [3]]
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(k, pa.int32())], names=["k"]) for k in keys]
    assert [(k, t.num_rows) for k, t in kernels.by_key(iter(batches), "k")] == [(1, 2), (2, 3), (3, 1)]


def test_ids_are_numbers(spark):
    named = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    for refuse in (substrings.dedup, suffixes.dedup, line_dedup.dedup):
        with pytest.raises(TypeError):
            refuse(named)


def test_suffixes_of_a_hot_passage(spark, monkeypatch):
    """Hundreds of texts share 300 bytes and nothing around them; a few share 420. Nothing short goes, all that is long does."""
    monkeypatch.setattr(suffixes, "MANY", 8)
    monkeypatch.setattr(suffixes, "TWIN_BITS", 16)
    rng = random.Random(8)
    own = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    hot, wide = own(300), own(60)
    texts = [own(300) + hot + own(300) for _ in range(300)]
    texts += [own(200) + wide + hot + wide + own(rng.randint(150, 250)) for _ in range(5)]
    rows = list(enumerate(texts))
    found = suffixes.dedup(spark.createDataFrame(rows, "doc_id int, text string")).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    want = brute.suffixes(rows, 400)
    same(found, want)
    assert [w[2] >= 420 for w in want] == [False] * 300 + [True] * 5 and not any(w[2] for w in want[:300])


def test_suffix_sort():
    from tidemark.llm.suffix_sort import common_prefixes, suffix_array

    rng = random.Random(3)
    for _ in range(2000):
        text = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 20))] + [0]
        order = suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        for k, n in enumerate(common_prefixes(text, order, 0)):
            if k:
                a, b = text[order[k - 1] :], text[order[k] :]
                assert a[:n] == b[:n] and (a[n : n + 1] != b[n : n + 1] or a[n] == 0)


def test_repeats_of_many_variants():
    rng = random.Random(5)
    for _ in range(300):
        base = [rng.choice(b"ab") for _ in range(24)]
        pieces = set()
        for _ in range(rng.randint(2, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.choice([*range(8), *range(12, 24)])] = rng.choice(b"abc")
            a, b = rng.randint(0, 4), rng.randint(18, 24)
            pieces.add((bytes(own[a:b]), 8 - a))
        pieces = sorted(pieces)
        for i, ranges in enumerate(suffixes.repeats(pieces, 9)):
            got = {s for lo, hi in ranges for s in range(lo, hi)}
            p, off = pieces[i]
            want = {s for s in range(max(0, off - 5), off + 1) if any(j != i and 0 <= s - off + o and q[s - off + o : s - off + o + 9] == p[s : s + 9] and len(p[s : s + 9]) == 9 for j, (q, o) in enumerate(pieces))}
            assert want <= got and all(any(j != i and q[s - off + o : s - off + o + 9] == p[s : s + 9] for j, (q, o) in enumerate(pieces) if s - off + o >= 0) for s in got)


def test_simhash(docs, rows, empty):
    want, _ = brute.simhash([r[:2] for r in rows])
    same(simhash.digest(docs), want)
    assert simhash.digest(empty).count() == 0
    kept = simhash.keep_one(docs, 4)
    assert kept.columns == docs.columns
    _, group = brute.simhash([r[:2] for r in rows])
    assert kept.count() == len(set(group)) and simhash.keep_one(empty, 4).count() == 0


def test_large_balls_keep_every_link():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    center = rng.getrandbits(64)
    prints = sorted({center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)})
    batch = pa.RecordBatch.from_arrays([pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=["fp"])
    edges = list(simhash._verify(iter(list(simhash._ball(3)(iter([batch]))))))
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for e in edges:
        for u, v in zip(e.column(0).to_pylist(), e.column(1).to_pylist()):
            up[find(u % (1 << 64))] = find(v % (1 << 64))
    assert sum(e.num_rows for e in edges) < len(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                assert find(a) == find(b)


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101), (103, 101), (5, 5), (7, 8), (8, 7)]
    found = components.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(21)} | {i: 100 for i in (100, 101, 103)}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_line_dedup(docs, rows, empty):
    want = brute.line_dedup([r[:2] for r in rows])
    same(line_dedup.dedup(docs.select("doc_id", "text")), want)
    assert line_dedup.dedup(docs).columns == [c for c in docs.columns] + ["n_lines", "n_removed"]
    assert line_dedup.digest(empty).count() == 0


def test_line_dedup_in_other_orders(spark):
    """Lines that cross in their first holder: pairs of neighbours find the document that holds them in order."""
    lines = [f"line number {k} of all" for k in range(9)]
    rng = random.Random(4)
    texts = ["\n".join((lines[1], lines[0])), "\n".join((lines[0], lines[1])), "\n".join((lines[0], lines[1], "end")), *("\n".join(rng.sample(lines, rng.randint(1, 8))) for _ in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = brute.line_dedup(list(enumerate(texts)))
    same(line_dedup.dedup(docs).select("doc_id", "text", "n_lines", "n_removed"), want)
    assert want[2][3] == 2
    # four documents: two earlier ones hold a line each, the last holds both
    four = [(0, "x a b c\nown"), (1, "y a b c\nhere"), (2, "x a b c\ny a b c"), (3, "x a b c\ny a b c")]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup(spark.createDataFrame(four, "doc_id int, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2} and [x[3] for x in brute.line_dedup(four, True)] == [0, 0, 2, 2]


def test_line_dedup_loses_no_aligned_line(spark):
    """First holders of lines and of what surrounds them delete what alignment with every earlier document does."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert brute.line_dedup(rows) == brute.line_dedup(rows, every_pair=True)


def test_patience_against_brute_force():
    rng = random.Random(9)
    for _ in range(3000):
        a, b = ([rng.randint(0, k) for _ in range(rng.randint(0, 9))] for k in (rng.choice([1, 3, 12]),) * 2)
        assert {i for s, _, n in line_dedup.patience(a, b) for i in range(s, s + n)} == brute.patience(a, b)


def test_patience():
    assert line_dedup.patience([1, 2, 3, 9, 4], [1, 2, 3, 8, 4]) == [(0, 0, 3), (4, 4, 1)]
    assert line_dedup.patience([5, 1, 2], [1, 2, 6]) == [(1, 0, 2)]
    assert line_dedup.patience([1, 1, 1], [1, 1]) == [(0, 0, 2)]
    assert line_dedup.patience([7, 3, 3, 8], [9, 3, 3, 6]) == [(1, 1, 2)]
    assert line_dedup.patience([], [1]) == []


def test_base_statistics(docs, rows, empty):
    got = outliers.statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    same(got, [(r[0], *brute.base_statistics(r[1])) for r in rows])
    judged = outliers.digest(docs)
    assert judged.count() == len(rows) and judged.where("base_failed and kept").count() == 0
    assert judged.where("base_failed <> (n_words < 50 or 100 * n_repeat_words > 50 * n_words)").count() == 0
    assert outliers.digest(empty).count() == 0


def test_mixing(docs, rows, empty):
    for weights, block in (((1, 2, 3), 64), ((1, 50), 16)):
        out = mixing.digest(docs, weights=weights, block=block)
        target, taken = brute.mixing([(r[0], r[1], r[3]) for r in rows], weights)
        sources = {(r[0], len(brute.SPACE.findall(r[1] or ""))): r[3] for r in rows}
        found = out.collect()
        assert len(found) == len(rows)
        total = dict.fromkeys(taken, 0)
        for r in found:
            assert abs(r["target"] - target[sources[r["doc_id"], r["size"]]]) < 1e-6 and r["taken"] <= 3 * r["size"]
            total[r["doc_id"]] += r["taken"]
        single = {d for d in taken if sum(r[0] == d for r in rows) == 1}
        assert all(total[d] == taken[d] for d in single) and sum(total.values()) == sum(taken.values())
    assert mixing.digest(empty).count() == 0


def test_schedule_is_spread(docs):
    laid, schedule = mixing.mix(docs, block=16)
    slots = [r["s"] for r in schedule.select("slot", "s").distinct().orderBy("slot").collect()]
    share = {s: slots.count(s) / len(slots) for s in set(slots)}
    for n in (50, 100, len(slots)):  # every prefix of the schedule is near the shares
        assert all(abs(slots[:n].count(s) - n * share[s]) <= 6 for s in share)


def test_line_dedup_deletes_short_shared_lines(spark):
    texts = ["A short line here.\nOnly the first has this.", "Only the second has that.\nA short line here.\nIts own end.", "Word\nAnother own line.", "Third own line.\nWord"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    kept = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup(docs).collect()}
    assert kept == {0: (texts[0], 0), 1: ("Only the second has that.\nIts own end.", 1), 2: (texts[2], 0), 3: ("Third own line.", 1)}
