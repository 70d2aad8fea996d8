"""Fitted operators: held-out accuracy, planted outliers, HTML fixtures, and the pipeline against brute force."""

from __future__ import annotations

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import html_text, language, outliers, quality
from tidemark.llm.queries import oracle_sql, queries

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
ODD = [(None, None, None, None, 0), (-1, "", "en", "a", 0), (-2, "123 !!", None, None, 0), (-3, "x", "fr", "b", 0), (-3, "x", "fr", "b", 0)]
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out(spark, docs):
    found = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    both = docs.unionByName(spark.createDataFrame(ODD, KIND))
    odd = {(r["doc_id"], r["lang_pred"] == "und", r["score"] > 0) for r in language.digest(both).where("doc_id < 0 or doc_id is null").collect()}
    assert odd == {(None, True, False), (-1, True, False), (-2, True, False), (-3, False, True)}
    assert language.digest(docs.limit(0)).count() == 0
    nothing = language.digest(docs.withColumn("lang", F.lit(None).cast("string")).limit(5)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_language_probabilities_sum_to_one():
    import numpy as np

    model = language.Model({"a": [b"abcab", b"cabba"], "b": [b"bbbca", b"acccb"]}, order=3)
    size = len(model.alphabet) + 2
    for head in (0, 1, 3, 4, (3 << language.BITS) | 4, (1 << language.BITS) | 1, (5 << language.BITS) | 3):
        grams = np.array([(head << language.BITS) | c for c in [2, *range(3, 3 + len(model.alphabet))]], dtype=np.int64)
        total = np.exp(model.log_prob(grams, 3)).sum(axis=0)
        assert (total <= 1 + 1e-5).all() and (total > 1 - 2 / size).all()


def test_many_languages_share_what_the_driver_holds(spark, monkeypatch):
    import numpy as np

    names = [f"x{k:02d}" for k in range(30)]
    words = {x: [f"{x[1]}{c}{x[2]}" for c in "abcdefgh"] for x in names}
    rows = [(30 * j + k, " ".join(words[x][(j * i) % 8] for i in range(40)), x) for k, x in enumerate(names) for j in range(12)]
    frame = spark.createDataFrame([*rows, (9002, "one text of a rare language", "rare"), (9008, "word " * 900, "rarer"), (9009, "words " * 900, "rarer")], "doc_id bigint, text string, lang string")
    sizes = []
    kept = language.Model.__init__
    monkeypatch.setattr(language.Model, "__init__", lambda self, texts, **o: (sizes.append({x: sum(map(len, t)) for x, t in texts.items()}), kept(self, texts, **o))[1])
    model = language.fit(frame, most=31, all_bytes=31 * 500)
    assert len(sizes[0]) == 31 and set(names) < set(sizes[0]) and all(0 < n <= 500 for x, n in sizes[0].items() if x in names)
    assert [p.width for p in model.parts] == [8, 8, 8, 7]
    texts = [t.encode() for _, t, _ in rows[::7]] + [b"", b"12 ?", "世界 new".encode()]
    data, offsets = language._joined(texts)
    apart = model.losses(data, offsets)[0]
    monkeypatch.setattr(language, "WIDTH", 64)
    whole = language.fit(frame, most=31, all_bytes=31 * 500)
    assert len(whole.parts) == 1 and np.allclose(apart, whole.losses(data, offsets)[0], rtol=1e-5, atol=1e-4)
    assert np.allclose(model.limit, whole.limit, rtol=1e-5) and model.judge(data, offsets)[0] == whole.judge(data, offsets)[0]
    language.fit(frame.where("lang = 'rarer'"), all_bytes=100)
    assert sizes[-1] == {"rarer": 4500}


def test_language_models_against_dictionaries(docs):
    import numpy as np

    texts = {}
    for r in docs.where("doc_id < 300 and lang is not null and length(text) between 30 and 3000").select("lang", "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    train = {x: own[:9] for x, own in texts.items()}
    model = language.Model({x: [t.encode() for t in own] for x, own in train.items()})
    counted = {x: own[: max(1, len(own) - max(1, len(own) // 5))] for x, own in train.items()}
    plain = {x: brute.KneserNey(own, language.ORDER, len(model.alphabet) + 2) for x, own in counted.items()}
    known = {chr(c) for c in model.alphabet}
    rest = [t for own in texts.values() for t in own[9:14]] + ["a", "Ünknown ☃ signs 世界"]
    raw = [t.encode() for t in rest]
    loss, chars, has = model.losses(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(b) for b in raw]))))
    for k, t in enumerate(rest):
        same = "".join(c if brute.lower(c) in known else "\0" for c in t)  # one class for all unknown characters
        want = [plain[x].loss(same) for x in model.langs]
        assert chars[k] == len(t) and has[k] and np.allclose(loss[k], want, rtol=1e-4, atol=1e-3)


def test_language_learns_from_a_bounded_sample(spark, docs):
    few = language.fit(docs, per_lang=3)
    less = language.fit(docs, per_lang=3, max_bytes=1)
    assert few.langs == less.langs and len(few.parts[0].keys[4]) > len(less.parts[0].keys[4]) > 0
    with pytest.raises(ValueError):
        language.Model({"a": [b"abc"]}, order=5)


def test_quality_against_densities(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    own = {r["doc_id"]: r["quality"] for r in labels.collect()}
    odd = spark.createDataFrame(ODD, KIND)
    rows = docs.unionByName(odd).select("doc_id", "text").collect()
    want = brute.discriminant([(brute.quality_features(r["text"]), own.get(r["doc_id"]) if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 else None) for r in rows])
    got = {(r["doc_id"]): (r["score"], r["held_out"]) for r in quality.digest(docs.unionByName(odd), labels).collect()}
    assert all(abs(got[r["doc_id"]][0] - s) < 1e-6 for r, s in zip(rows, want))
    assert got[None][1] is False and all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, (_, h) in got.items() if d is not None)


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.digest(docs, labels)
    rows = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = [[r["score"] for r in rows if r["quality"] == q] for q in (1, 0)]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    both = spark.createDataFrame(ODD, KIND)
    odd = quality.digest(both, labels).collect()
    assert len(odd) == 5 and all(r["score"] is not None for r in odd)
    assert quality.digest(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in quality.digest(both, labels.limit(0)).collect()} == {0.5}


def test_labels_are_learned_only_where_allowed(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    few = docs.limit(200)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in quality.digest(few, x).collect()) for x in (labels, flipped))
    assert [x[0] for x in a] == [x[0] for x in b] and all(abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b))
    assert zlib.crc32(b"7") % 3 in (0, 1, 2)


def test_outliers_reject_junk_and_keep_clean(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = outliers.judge(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"), F.count("*").alias("n")).collect()
    kept = {r["quality"]: r["k"] for r in rows}
    assert kept[0] < 0.1 and kept[1] > 0.97


def test_outliers_against_brute_force(spark, docs):
    """Nulls, one-row groups, constant columns, ties and repeated rows included."""
    some = docs.where("doc_id % 3 = 0").unionByName(spark.createDataFrame(ODD, KIND)).unionByName(docs.where("doc_id < 3").withColumn("source", F.lit("alone")))
    some = some.unionByName(docs.where("doc_id = 3").withColumn("lang", F.lit(None).cast("string"))).unionByName(docs.where("doc_id = 6"))
    rows = outliers.judge(some).select("*", *(v.alias(f"x{k}") for k, v in enumerate(outliers.transformed()))).collect()
    judged = [r for r in rows if not r["base_failed"]]
    want = brute.outliers([(r["lang"], r["source"], [r[f"x{k}"] for k in range(4)]) for r in judged], outliers.FLOOR)
    assert len(judged) > 250 and max(abs(r["distance"] - d) / max(d, 1e-3) for r, d in zip(judged, want)) < 1e-6
    assert all(r["kept"] == (d <= outliers.CUT) for r, d in zip(judged, want)) and not any(r["kept"] for r in rows if r["base_failed"])
    constant = spark.createDataFrame([(k, " ".join(f"word{j}" for j in range(60)), "en", "a", 0) for k in range(5)], KIND)
    assert {r["kept"] for r in outliers.digest(constant).collect()} == {True}


def test_outliers_reject_repetition_alone(spark):
    """One planted text for each of the two shares, in a source where nobody repeats."""
    import itertools
    import random

    rng = random.Random(2)
    made = iter(dict.fromkeys("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40_000)))
    words = lambda n: list(itertools.islice(made, n))
    text = lambda w: "\n".join(" ".join(w[k : k + 10]) for k in range(0, len(w), 10))
    few = words(6)
    walk, seen = few[:1] * 2, set()
    while len(walk) < 60:  # lines of one word, no three of them twice in a row
        walk.append(next(w for w in reversed(few) if (*walk[-2:], w) not in seen))
        seen.add(tuple(walk[-3:]))
    again = words(24)
    lines, repeats = "\n".join([*walk, " ".join(words(100))]), text([*words(30), *again, *words(21), *again, *words(1)])
    rows = [(k, text(words(100)), "en", "a") for k in range(120)] + [(1000, lines, "en", "a"), (1001, repeats, "en", "a")]
    found = {r["doc_id"]: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert (found[1000]["n_repeat_words"], found[1001]["n_dup_lines"]) == (0, 0) and not any(r["base_failed"] for r in found.values())
    assert {k for k, r in found.items() if not r["kept"]} == {1000, 1001}


PAGE = '<html><head><title>T</title></head><body class="no-sidebar"><header><a>Home</a></header><div class="cookie-notice">We use cookies.</div><div id="wrap"><main><article class="post"><h1>Title &amp; more</h1><p>First   para, with <b>bold</b> text.<p>Second.<ul><li>One item<li>Two</ul><aside>Side.</aside><div class="ad-box">Buy.</div><pre>code  here</pre><form><input value="x">Subscribe</form></article><section id="comments"><p>I liked it, really, a very long comment here, it goes on, and on.</p></section></main><aside class="sidebar"><p>Links</p></aside></div><footer>(c)</footer></body></html>'
TEXT = "Title & more\nFirst para, with bold text.\nSecond.\nOne item\nTwo\ncode here"


WRAPPED = '<div id="page" class="site has-sidebar"><div class="header-fixed wrap"><article class="post"><h1>Head</h1><p>Body text, here.</p></article></div><div class="sidebar"><p>Side.</p></div><div class="related-posts"><article><p>Another article, with text.</p></article></div><ol id="comments"><li><article class="comment-body"><p>A comment, a long one, it goes on.</p></article></ol></div>'


def test_html(spark):
    rows = [(1, "u", PAGE), (2, "u", PAGE.replace("article", "div").replace("main>", "div>")), (3, None, None), (4, "u", ""), (5, "u", "plain &amp text"), (6, "u", "<p>a &lt; b<p>c<!-- x"), (7, "u", "<div><p>x</p><script>a<b"), (7, "u", "<div><p>x</p><script>a<b"), (8, "u", '<p a=">">y</p><p'), (9, "u", "<nav>only menu</nav>"), (10, "u", WRAPPED)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.digest(pages).collect())
    want = [(1, TEXT), (2, TEXT), (3, ""), (4, ""), (5, "plain & text"), (6, "a < b\nc"), (7, "x"), (7, "x"), (8, "y"), (9, ""), (10, "Head\nBody text, here.")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    clash = html_text.extract(pages.withColumn("text", F.lit("old")).withColumn("n_chars", F.lit(1)))
    assert clash.where("page_id = 7").first()["text"] == "x" and html_text.digest(pages.limit(0)).count() == 0


def test_html_without_an_article_keeps_its_tail():
    part = "<p>A paragraph of the text, with commas, and some more words.</p>"
    said = "A paragraph of the text, with commas, and some more words."
    for tail in ("<div class=part2><p>The last part, also said, in a div.</p></div>", "<section><p>The last part, also said, in a div.</p></section>"):
        page = f"<body><div class=menu><a>Home</a></div><div class=content><div class=body>{part * 12}</div>{tail}</div></body>"
        assert html_text.main_text(page) == "\n".join([said] * 12 + ["The last part, also said, in a div."])


def test_html_keeps_cells_and_short_sections_and_leaves_sidebars():
    said = "A long paragraph of the article, with commas, and several sentences. It goes on for a while, so that it counts."
    assert html_text.main_text(f"<div><p>{said}</p><table><tr><td>cell one</td><td>cell two</td></tr></table></div>").split("\n") == [said, "cell one", "cell two"]
    assert html_text.main_text(f"<div id=c><div><p>{said}</p></div><div><p>{said}</p></div><div><p>Short end.</p></div></div>").split("\n") == [said, said, "Short end."]
    assert html_text.main_text(f"<body><div><p>{said}</p><ul><li>one item</li></ul></div><div class=sidebar><p>Read this, too.</p></div></body>").split("\n") == [said, "one item"]
    assert html_text.main_text(f"<article><header><h1>Title</h1></header><p>{said}</p></article>") == said


def test_html_threshold_decides():
    """Without any telling tag or name: paths of text stay, short ones and links go; no threshold keeps all, a large one nothing."""
    part = "<p>A paragraph of the text, with commas, that goes on for a while, as they do.</p>"
    said = "A paragraph of the text, with commas, that goes on for a while, as they do."
    page = f"<div><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div><div><span>Log in</span></div><div><h2>Title</h2>{part * 6}<p>Short.</p></div><div><div>All rights reserved</div></div>"
    assert html_text.main_text(page) == "\n".join(["Title", *[said] * 6, "Short."])
    assert html_text.main_text(page, 0) == "\n".join(["Home", "News", "Log in", "Title", *[said] * 6, "Short.", "All rights reserved"])
    assert html_text.main_text(page, 1e9) == "" and html_text.main_text(PAGE, 1e9) == "" and html_text.main_text(PAGE, 0) != TEXT


def test_html_deep_nesting_takes_linear_time():
    import time

    n = 100_000
    began = time.time()
    assert html_text.main_text("<div>x" * n).count("x") == n
    assert html_text.main_text("<b>" * n + "<p>y" * n) == "\n".join("y" * n)
    assert html_text.main_text("<i>" * n + "</u>" * n + "z") == "z"
    assert time.time() - began < 30


def test_html_of_test_data(spark):
    import html
    import re

    for r in queries()["op10_html_text"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*(>|$)", "", x.replace("<br>", " ")))).strip() for x in re.split("</?(?:p|h1)>", body))
        assert r["text"] == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracles(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries()[name](spark, SMALL)
    found = c.sql(oracle_sql()[name])
    columns = sorted(df.columns)
    at = [found.columns.index(x) for x in columns]
    assert sorted(tuple(r[x] for x in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in found.fetchall())


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage after the language models is computed again in plain Python from the stage before."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(spark.createDataFrame(ODD, KIND)).withColumn("score", F.lit("kept"))
    steps = dict(corpus_pipeline.STAGES)
    one = steps["language_id"](spark, docs, SMALL)
    assert one.columns == docs.columns and {r["score"] for r in one.collect()} == {"kept"}
    model = language.fit(docs)
    import numpy as np

    want = []
    for r in docs.collect():
        raw = np.frombuffer((r["text"] or "").encode(), np.uint8)
        if model.judge(raw, np.array([0, len(raw)]))[2][0]:
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(want) and len(want) > 190
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    lines = [x for x in brute.line_dedup(rows) if not x[3] or x[2] > x[3]]
    two = steps["line_dedup"](spark, one, SMALL)
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in two.collect()) == sorted((d, t, len(t)) for d, t, _, _ in lines)
    rows = [(d, t) for d, t, _, _ in lines]
    group = brute.similar([t for _, t in rows])
    least = {}
    for (d, t), g in zip(rows, group):
        least[g] = min(least.get(g, (d, t)), (d, t), key=lambda x: x[0])
    three = steps["simhash_near_dedup"](spark, two, SMALL)
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(d for d, _ in least.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {x[0] for x in brute.contamination(list(least.values()), items) if not x[5]}
    four = steps["decontaminate"](spark, three, SMALL)
    assert {r["doc_id"] for r in four.collect()} == clean
    five = steps["mix_sources"](spark, four, SMALL)
    _, taken = brute.mixing([(r["doc_id"], r["text"], r["source"]) for r in four.collect()])
    assert {r["doc_id"]: r["taken"] for r in five.collect()} == {d: taken[d] for d in clean}
    empty = docs.limit(0)
    for stage in steps.values():
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 150 and [len(corpus_pipeline.STAGES), out.columns[0]] == [5, "doc_id"]
