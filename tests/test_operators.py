"""Hand-computed cases of the core operators."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.ports import generated
from tidemark.functions import dates, payload, text
from tidemark.operators import attention, catalog, corpus, emergence, funding, packing, runs, topics, vectors, versions
from tidemark.sources import files, paged, row_groups, sinks

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    ("first", "second", "winner", "uncertain"),
    [
        ("2019-07-04", "2019-07-04", 2, False),
        ("2019-07-05", "2019-07-04", 1, False),
        ("2019-07-04T20:30:00-04:00", "2019-07-05T01:00:00Z", 2, False),
        ("2019-07-05T02:00:00+01:00", "2019-07-05T00:30:00Z", 1, False),
        ("someday", "2019-07-04", 2, True),
        ("2019-07-04", None, 2, True),
    ],
)
def test_reconcile_pairs(spark, first, second, winner, uncertain):
    seen = spark.createDataFrame([("s", "e", 1, first, True, 1), ("s", "e", 2, second, True, 2)], "scope_id string, entity_id string, version_id int, updated_date string, is_api boolean, observed_at int")
    for part in (seen, seen.orderBy(F.desc("version_id"))):
        r = versions.reconcile(part).first()
        assert (r["version_id"], r["uncertain"], r["conflict"], list(r["version_ids"])) == (winner, uncertain, True, [1, 2])


def test_reconcile_undated_and_ties(spark):
    schema = "scope_id string, entity_id string, version_id string, updated_date string, is_api boolean, observed_at int"
    data = [("s", "e", "new", "2026-01-03", True, 0), ("s", "e", "unknown", None, True, 1), ("s", "e", "old", "2026-01-01", True, 2), ("s", "t", "a", None, False, 1), ("s", "t", "b", None, False, 1), ("s", "k", "snap", "2026-02-01", False, 9), ("s", "k", "api", "2026-01-01", True, 9)]
    assert {r["entity_id"]: r["version_id"] for r in versions.reconcile(spark.createDataFrame(data, schema)).collect()} == {"e": "unknown", "t": "b", "k": "snap"}


def test_emergence_hand_case(spark):
    works = [("a1", D(2024, 1, 5), "A", False), ("b1", D(2024, 2, 1), "B", False), ("b2", D(2024, 3, 1), "B", False), ("x1", D(2024, 4, 1), None, True), ("a2", D(2025, 1, 1), "A", False), ("a3", D(2025, 5, 1), "A", False), ("b3", D(2025, 6, 1), "B", False), ("b4", D(2025, 7, 1), "B", False), ("x2", D(2026, 1, 10), None, True)]
    df = spark.createDataFrame(works, "work_id string, published date, topic string, is_outlier boolean")
    names = spark.createDataFrame([("A",), ("B",)], "topic string")
    args = (df.select("work_id", "published"), df.select("work_id", "topic", "is_outlier"), names, D(2024, 1, 1), D(2026, 1, 15))
    out = {r["topic"]: r for r in emergence.observe(*args).collect()}
    a = out["A"]
    assert list(a["complete_years"]) == [2024, 2025]
    assert math.isclose(a["mean_share"], 0.375) and math.isclose(a["annual_growth"], 1.0) and a["valid_year_pair_count"] == 1
    assert (a["coverage_status"], a["emergence_quadrant"], out["B"]["coverage_status"]) == ("scored", "wisdom_weak", "scored")
    assert a["monthly_series"][-1]["year_month"] == "2026-01"
    short = emergence.observe(*args[:3], D(2024, 1, 1), D(2024, 12, 31)).collect()
    assert {r["coverage_status"] for r in short} == {emergence.INSUFFICIENT} and all(r["mean_share"] is None for r in short)
    none = emergence.run_status(emergence.observe(*args[:2], names.limit(0), *args[3:]))
    assert none.first()[0] == "none"
    with pytest.raises(ValueError):
        emergence.require_works(args[1], args[0].where("work_id <> 'a1'"))


def test_gaps_and_their_errors(spark):
    totals = spark.createDataFrame([("f", 10), ("g", 4), ("h", 3)], "file string, total bigint")
    make = lambda r: spark.createDataFrame(r, "file string, start bigint, count bigint")
    assert rows(packing.coverage_gaps(make([("f", 2, 3), ("f", 7, 1), ("h", 0, 3)]), totals)) == [("f", 0, 2), ("f", 5, 7), ("f", 8, 10), ("g", 0, 4)]
    for bad in ([("f", 0, 0)], [("f", 0, 3), ("f", 2, 2)], [("f", 8, 5)]):
        with pytest.raises(Exception, match="invalid committed source coverage"):
            packing.coverage_gaps(make(bad), totals).collect()


def test_packing_is_greedy(spark):
    one = spark.range(1)
    pack = lambda sizes, items, most: one.select(packing.pack(F.array(*map(F.lit, sizes)).cast("array<bigint>"), items, most)).first()[0]
    assert pack([5, 5, 5], 2, 100) == [0, 0, 1]
    assert pack([60, 60, 10, 200, 1], 9, 100) == [0, 1, 1, 2, 3]
    with pytest.raises(Exception, match="expanded record exceeds limit"):
        packing.bounded_chunks(spark.createDataFrame([("f", 1, 9)], "f string, o int, s int"), "f", "o", "s", 2, 5, 8).collect()


def test_window_split_trace(spark):
    states = [(10, 10, False, 4, "complete"), (12, 3, True, 4, "split"), (12, 12, False, 1, "complete"), (150, 10, True, 1, "truncated"), (None, 10, True, 2, "split"), (20, 5, False, 1, "truncated")]
    df = spark.createDataFrame(states, "total int, fetched int, more boolean, span int, expected string")
    got = df.select(attention.scan_status(F.col("total"), F.col("fetched"), F.col("more"), 10, F.col("span")).alias("s"), "expected").collect()
    assert [r["s"] for r in got][0] == "complete" and got[3]["s"] == "truncated" and got[4]["s"] == "split" and got[5]["s"] == "truncated"
    scan = spark.createDataFrame([("p", "c", "t", 1, D(2024, 1, 1), D(2024, 4, 1), "split")], "platform string, channel string, term_id string, scan_id int, window_start date, window_end date, status string")
    assert [(r["window_start"], r["window_end"]) for r in attention.split_children(scan).orderBy("window_start").collect()] == [(D(2024, 1, 1), D(2024, 2, 1)), (D(2024, 2, 1), D(2024, 4, 1))]


def test_attention_coverage(spark):
    links = spark.createDataFrame([("T1", "a"), ("T1", "b"), ("T2", "c")], "topic_id string, term_id string")
    scans = spark.createDataFrame([("hn", "all", "a", 1, D(2024, 1, 1), D(2024, 3, 1), "complete", 6), ("hn", "all", "b", 2, D(2024, 1, 1), D(2024, 2, 1), "complete", 2), ("hn", "all", "b", 3, D(2024, 2, 1), D(2024, 3, 1), "truncated", 150)], "platform string, channel string, term_id string, scan_id int, window_start date, window_end date, status string, reported_total bigint")
    mentions = spark.createDataFrame([(i, "hn", "all", D(2024, 1, 2), f"u{i % 2}", 3) for i in range(6)], "mention_id int, platform string, channel string, created_at date, author_hash string, engagement bigint")
    matched = mentions.selectExpr("'a' AS term_id", "mention_id").unionByName(mentions.selectExpr("'b' AS term_id", "mention_id"))
    spine = spark.createDataFrame([("hn", "all", D(2024, 1, 1)), ("hn", "all", D(2024, 2, 1)), ("bsky", "all", D(2024, 1, 1))], "platform string, channel string, month date")
    volumes = spark.createDataFrame([("hn", "all", D(2024, 1, 1), 5000), ("hn", "all", D(2024, 2, 1), 0)], "platform string, channel string, month date, total bigint")
    counted = attention.measures(links, matched, mentions, F.trunc("created_at", "MM"), F.lit(D(2024, 1, 1)), F.lit(D(2024, 3, 1)))
    cube = {(r["topic_id"], r["platform"], r["month"].month): r for r in attention.cube(links, counted, attention.coverage(links, attention.observed_cells(scans), spine), volumes).collect()}
    jan, feb = cube["T1", "hn", 1], cube["T1", "hn", 2]
    assert (jan["mentions"], jan["authors"], jan["engagement"], jan["estimated"], jan["coverage"]) == (6, 2, 18, 6, "complete") and math.isclose(jan["share"], 6 / 5000)
    assert (feb["mentions"], feb["estimated"], feb["share"], feb["coverage"]) == (0, 150, None, "truncated")
    assert (cube["T1", "bsky", 1]["coverage"], cube["T1", "bsky", 1]["estimated"]) == ("missing", None)
    assert cube["T2", "hn", 1]["coverage"] == "missing"


def test_headlines(spark):
    cases = {
        "Report: Oakmere Tools bags €3.2 million pre-seed financing led by Mill Street, others": ("vc_round", "Oakmere Tools", "pre_seed", 3.2e6, "EUR", "Mill Street"),
        "Harrow Optics merges with Tallow Lane for £90m": ("m_and_a", "Harrow Optics", None, 9e7, "GBP", None),
        "Завод «Сирень» привлёк 12,5 млн евро в раунде серии В под руководством Ландыш": ("vc_round", "Сирень", "series_b", 1.25e7, "EUR", "Ландыш"),
        "Прогноз: спрос на стекло вырастет": None,
        "Forecast of glass demand raises $5 billion questions": None,
        "Village hall reopens": None,
    }
    df = spark.createDataFrame([(h,) for h in cases], "title string")
    for r in df.select("title", funding.extract(F.col("title")).alias("e")).collect():
        assert (tuple(r["e"]) if r["e"] else None) == cases[r["title"]], r["title"]
    raw = spark.createDataFrame([("Heat - proof glass ( thin ) sells at € 3 . 75 , up 12 % | Glass Weekly | Home",)], "t string")
    assert raw.select(funding.clean(F.col("t"))).first()[0] == "Heat-proof glass (thin) sells at €3.75, up 12%"


def test_abstracts_and_json(spark):
    cases = [('{"far":[3],"so":[0,2],"good":[1]}', "so good so far", "so good so far"), ('{"b":[0],"a":[0]}', "a b", "a b"), ("{}", None, ""), ('{"a":[1.5]}', None, ""), ('{"a":["1"],"b":[0]}', None, "b"), ('{"a":[null,4]}', None, "a"), (None, None, None), ("[1]", None, None), ('{"":[0]}', None, "")]
    df = spark.createDataFrame([(k, i) for k, (i, _, _) in enumerate(cases)], "k int, i string")
    got = {r["k"]: (r["a"], r["b"]) for r in df.select("k", payload.abstract(F.col("i")).alias("a"), payload.lenient_abstract(F.col("i")).alias("b")).collect()}
    assert got == {k: (a, b) for k, (_, a, b) in enumerate(cases)}
    raw = {'{"z":2.50,"a":[2e2,-0.0,false,null,1E-3],"ä":"1.50"}': '{"a":[200,0,false,null,0.001],"z":2.5,"ä":"1.50"}', "[10, 10.0, 1e1]": "[10,10,10]", '"x"': '"x"', "-7.250": "-7.25"}
    df = spark.createDataFrame([(t,) for t in raw], "t string")
    assert {r["t"]: r["c"] for r in df.select("t", payload.canonical(F.col("t")).alias("c")).collect()} == raw
    for bad in ("NaN", "[Infinity]"):
        with pytest.raises(ValueError):
            payload.canonical_json(bad)


def test_text(spark):
    df = spark.createDataFrame([("a__b  C-d!",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(text.normalize(F.col("t"))).collect()] == ["a  b c d", "", ""]
    phrase = spark.createDataFrame([("The cat sat.", "cat"), ("The cats sat.", "cat")], "t string, p string")
    assert [r[0] for r in phrase.select(text.contains_phrase(F.col("t"), F.col("p"))).collect()] == [True, False]
    markup = spark.createDataFrame([("<p>a &amp;lt; b</p>",)], "t string")
    assert markup.select(text.plain(F.col("t")), text.plain_udf(F.col("t"))).first()[:] == ("a &lt; b", "a &lt; b")


def test_dates(spark):
    df = spark.range(1).select(dates.months(F.lit(D(2024, 1, 1)), F.lit(D(2024, 4, 1))).alias("m"), dates.complete_years(F.lit(D(2023, 6, 1)), F.lit(D(2025, 12, 31))).alias("y"), dates.iso_date(F.lit("2024-02-30")).alias("d"), dates.utc_instant(F.lit("2024-01-01T00:00:00+02:00")).cast("string").alias("t"))
    r = df.first()
    assert len(r["m"]) == 3 and list(r["y"]) == [2024, 2025] and r["d"] is None and r["t"] == "2023-12-31 22:00:00"


def test_scope_and_ledger(spark):
    scope = corpus.Scope(D(2024, 1, 1), D(2024, 12, 31), domains=("1",))
    cases = [("2030-01-01", True, "w", "1", "excluded:expansion"), ("x", None, "w", "1", "quarantine:publication_date"), ("2024-05-05", None, "w", "1", "quarantine:corpus_flag"), ("2023-05-05", False, "w", "1", "excluded:date"), ("2024-05-05", False, "", "1", "quarantine:identity"), ("2024-05-05", False, "w", None, "excluded:classification"), ("2024-05-05", False, "w", "1", "selected")]
    df = spark.createDataFrame(cases, "p string, x boolean, i string, d string, e string")
    got = df.select(scope.disposition(F.col("p"), F.col("x"), F.col("i"), F.col("d"), F.lit(None).cast("string")).alias("g"), "e").collect()
    assert all(r["g"] == r["e"] for r in got)
    assert scope.source_filter()["filter"].startswith("from_publication_date:2024-01-01")
    with pytest.raises(ValueError):
        corpus.Scope(D(2025, 1, 1), D(2024, 1, 1))


def test_vectors_and_topics(spark):
    v = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [2.0, 0.0]), (3, "a", [0.0, 1.0]), (4, "b", [1.0, 0.0]), (5, "b", [-1.0, 0.0])], "i int, g string, v array<double>")
    near = {(r["g"], r["rank"]): r["i"] for r in vectors.nearest_to_centroid(v, "g", "i", "v", 2).collect()}
    assert near == {("a", 1): 1, ("a", 2): 2, ("b", 1): 4, ("b", 2): 5}
    m = spark.createDataFrame([("t", "b"), ("t", "a")], "topic string, work_id string")
    same = topics.composition(m.orderBy(F.desc("work_id"))).first()["composition_hash"]
    assert topics.composition(m).first()["composition_hash"] == same != topics.composition(m.limit(1)).first()["composition_hash"]
    texts = spark.createDataFrame([("p1", "x"), ("p2", "bad")], "point_id string, text string")
    cached = spark.createDataFrame([("p1", [0.5]), ("p9", [1.0])], "point_id string, vector array<double>")

    def port(batch):
        if "bad" in batch:
            raise ValueError
        return [[1.0] for _ in batch]

    assert rows(vectors.embed_missing(texts, cached, port)) == [("p1", [0.5]), ("p2", None)]
    assert {r["status"] for r in topics.label(spark.createDataFrame([("t", "p")], "topic string, prompt string"), lambda p: " Head ").collect()} == {"succeeded"}


def test_budget_and_profile(spark):
    waiting = spark.createDataFrame([(10, 2, 50, 2, 8), (10, 50, 1, 9, 1), (7, 9, 9, 4, 3), (5, 1, 1, 1, 1)], "c bigint, a bigint, b bigint, x bigint, y bigint")
    assert all(tuple(r["s"]) == (r["x"], r["y"]) for r in waiting.select("x", "y", catalog.budget(F.col("c"), 0.6, F.col("a"), F.col("b")).alias("s")).collect())
    p = spark.createDataFrame([("T", 1, 'Quantum "dots"', "display_name"), ("T", 2, "quantum dots", "keyword"), ("T", 3, "ai", "keyword")], "topic_id string, position int, phrase string, origin string")
    got = catalog.profile_terms(p, [], 4).collect()
    assert [(r["normalized"], r["origin"]) for r in got] == [("quantum dots", "display_name")]


def test_summaries_and_headlines(spark):
    works = spark.createDataFrame([("t", "w1", "One", "first text"), ("t", "w2", None, "second text"), ("t", "w3", "Bad", "x"), ("u", "w1", "One", "first text")], "topic string, work_id string, title string, abstract string")
    cached = spark.createDataFrame([("t", "w1", "known"), ("t", "w9", "of no work")], "topic string, work_id string, summary string")

    def generate(prompt):
        if "Bad" in prompt:
            raise ValueError
        return f" <{prompt}> "

    made = rows(topics.summaries(works, cached, generate, "{title}: {abstract}"))
    assert made == [("t", "w1", "known"), ("t", "w2", "<: second text>"), ("u", "w1", "<One: first text>")]
    count = lambda text: len(text.split())
    assert topics.windows(["a b", "c", "d e f g", "h"], count, 3) == ["a b\n\nc", "d e f g", "h"]
    parts = spark.createDataFrame([("few", 1, "a b"), ("few", 0, "c"), ("many", 0, "a b c"), ("many", 1, "d e f"), ("long", 0, "a b c d e f g"), ("fails", 0, "Bad")], "topic string, position int, summary string")
    got = {r["topic"]: tuple(r)[1:] for r in topics.headlines(parts, generate, count, "of: {summaries}", 5).collect()}
    assert got["few"] == ("<of: c\n\na b>", 1, "succeeded") and got["fails"] == (None, 1, "failed")
    assert got["many"] == ("<of: <of: a b c>\n\n<of: d e f>>", 2, "succeeded") and got["long"][1:] == (1, "succeeded")


def test_short_lists_and_failover(spark):
    near = spark.createDataFrame([("a", 7, 1), ("a", 8, 2), ("a", 9, 3), ("b", 1, 1), ("c", 4, 1)], "g string, i int, rank int")
    lists = spark.createDataFrame([("a", 9, [8, 8]), ("b", 5, [2, 3]), ("c", 2, None)], "g string, size int, items array<int>")
    assert rows(vectors.backfill(lists, near, "g", "i", 3)) == [("a", [7, 8, 9]), ("b", [2, 3]), ("c", [4])]
    calls = []

    def down(batch):
        calls.append("down")
        raise OSError

    port = vectors.failover([down, lambda batch: [[1.0]] * len(batch)])
    assert port(["x"]) == [[1.0]] and port(["y", "z"]) == [[1.0], [1.0]] and calls == ["down"]
    with pytest.raises(RuntimeError):
        vectors.failover([down])(["x"])
    table = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 2, 1)), (3, D(2024, 3, 1))], "point_id int, published date")
    assert vectors.matching(table, D(2024, 1, 15), D(2024, 3, 1)).count() == 2


def test_freeze_or_resume(spark):
    scans = spark.createDataFrame([("s1", "k1", "src1", "complete"), ("s2", "k2", "src2", "running"), ("s3", "k2", "src2", "failed")], "scan_id string, request_key string, source string, status string")
    make = lambda r: spark.createDataFrame(r, "request_id string, request_key string, source string, scan_id string")
    asked = make([("r1", "k1", "src1", None), ("r2", "k2", "src2", None), ("r3", "k9", "src9", None), ("r4", "k1", "src1", "s1")])
    assert rows(runs.freeze_or_resume(asked, scans)) == [("r1", "r1", "new"), ("r2", "s2", "resume"), ("r3", "r3", "new"), ("r4", "s1", "resume")]
    for bad, said in ((("r", "k1", "other", "s1"), "cannot change"), (("r", "k", "src1", "s77"), "unknown scan")):
        with pytest.raises(Exception, match=said):
            runs.freeze_or_resume(make([bad]), scans).collect()


def test_leases(spark):
    now, old = dt.datetime(2024, 5, 1, 12), dt.datetime(2024, 5, 1, 11)
    data = [(1, "p", "complete", 1, 1, None, old), (2, "p", "claimed", 1, 4, dt.datetime(2024, 5, 1, 11, 59), old), (3, "p", "pending", 0, 0, None, old), (4, "q", "failed", 3, 3, None, old), (5, "q", "failed", 2, 2, None, now), (6, "r", "failed", 2, 2, None, old)]
    queue = spark.createDataFrame(data, "id int, platform string, status string, attempts int, fence int, claimed_until timestamp, updated_at timestamp")
    held = runs.claim(queue, "platform", now, 60, dt.datetime(2024, 5, 1, 11, 30), 3)
    assert {(r["id"], r["attempts"], r["fence"]) for r in held.where("status = 'claimed'").collect()} == {(2, 2, 5), (6, 3, 3)}
    results = spark.createDataFrame([(2, 4, "complete"), (6, 3, "released"), (3, 0, "complete")], "id int, fence int, outcome string")
    after = {r["id"]: (r["status"], r["attempts"]) for r in runs.settle(held, results, now).collect()}
    assert after[2] == ("claimed", 2) and after[6] == ("pending", 2) and after[3] == ("pending", 0)
    waits = spark.range(1, 8).select(runs.backoff(F.col("id"), 2.0, 60.0, F.lit(1.0)).alias("w"))
    assert [r["w"] for r in waits.collect()] == [2.0, 4.0, 8.0, 16.0, 32.0, 60.0, 60.0]
    assert rows(runs.insert_once(spark.createDataFrame([(1, "old")], "k int, v string"), spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string"), ["k"])) == [(1, "old"), (2, "a")]


def test_chunks_of_a_long_file(spark):
    n = 200_000
    one = spark.range(n).select(F.lit("f").alias("file"), F.col("id").alias("o"), F.lit(7).alias("s"))
    found = packing.bounded_chunks(one, "file", "o", "s", 1000, 1 << 30, 100)
    assert found.agg(F.count("*"), F.sum("n"), F.max("chunk"), F.max("first")).first()[:] == (200, n, 199, n - 1000)
    assert packing.bounded_chunks(one.limit(0), "file", "o", "s", 2, 5, 8).count() == 0


def test_unit_vectors(spark):
    v = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1e-20, 0.0],)], "v array<float>")
    assert [r[0] for r in v.select(vectors.unit(F.col("v"))).collect()][:2] == [[0.6, 0.8], [0.0, 0.0]]


def test_crash_leaves_no_half_output(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    folder = tmp_path / "out"

    def broken(stage):
        if stage == "written":
            raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        sinks.publish(df, str(folder), broken)
    assert [p.name[:7] for p in folder.iterdir()] == [".aside-"]
    at = sinks.publish(df, str(folder))
    assert rows(spark.read.parquet(at)) == [(1, "a"), (2, "b")] and len([p for p in folder.iterdir() if p.name.startswith("part-")]) == 1
    spark.createDataFrame([(9, "z")], "k int, v string").write.mode("overwrite").parquet(at)
    with pytest.raises(ValueError, match="immutable output conflict"):
        sinks.publish(df, str(folder))
    scope = str(tmp_path / "scope")
    sinks.write_once(spark, scope, '{"from":"2024"}')
    sinks.write_once(spark, scope, '{"from":"2024"}')
    with pytest.raises(ValueError, match="cannot be changed"):
        sinks.write_once(spark, scope, '{"from":"2023"}')


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    at = sinks.publish(df, str(tmp_path / "out"))
    assert sinks.publish(df.orderBy(F.desc("k")), str(tmp_path / "out")) == at
    sinks.append_new(df, str(tmp_path / "t"), ["k"])
    sinks.append_new(spark.createDataFrame([(2, "z"), (3, "c"), (3, "c")], "k int, v string"), str(tmp_path / "t"), ["k"])
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(1, "a"), (2, "b"), (3, "c")]
    sinks.rebuild(df, str(tmp_path / "p"), "k")
    sinks.rebuild(spark.createDataFrame([(2, "new")], "k int, v string"), str(tmp_path / "p"), "k")
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("k", "v")) == [(1, "a"), (2, "new")]


def test_sources(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "r"))
    assert [r["id"] for r in row_groups.row_range(spark, str(next((tmp_path / "r").glob("part-*"))), 10, 13).collect()] == [10, 11, 12]
    manifest = spark.createDataFrame([([("s3/updated_date=2024-01-01/a", 5, 2), ("s3/updated_date=2024-02-01/b", 6, 3)], 11, 5)], "entries array<struct<url:string,bytes:bigint,rows:bigint>>, total_bytes bigint, total_rows bigint")
    assert [r["url"][-1] for r in files.inventory(manifest).collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        files.inventory(manifest.withColumn("total_rows", F.lit(4)))
    spark.dataSource.register(paged.api_source("pages_test", generated(len, 2, False), paged.CURSORS))
    assert rows(spark.read.format("pages_test").option("terms", "a|bbb").load().select("term", "page", "n", "last")) == [("a", 0, 1, True), ("bbb", 0, 2, False), ("bbb", 1, 1, True)]
    made = []
    for _ in range(2):
        assert files.read_or(spark, str(tmp_path / "cached"), lambda: made.append(1) or spark.range(3)).count() == 3
    assert made == [1]
    bodies = spark.createDataFrame([(1, '{"hits":[{"id":7},{"id":8}]}')], "page int, body string")
    assert rows(files.pages(bodies, "hits", "id:int")) == [(1, 7), (1, 8)]


def test_page_rules():
    ask = lambda pages, rules, **o: list(paged.scan(lambda r: pages[r.cursor if not r.only_total else "total"], rules, "t", o.get("first", ""), o.get("last", ""), ""))
    page = paged.Page
    assert [r[4] for r in ask({None: page("a", 2, "x", 3), "x": page("b", 1, None, 3)}, paged.PAGE_NUMBERS)] == [2, 1]
    for pages, said in (
        ({None: page("a", 2, "x", 3), "x": page("b", 1, None, 4)}, "changed"),
        ({None: page("a", 2, "x", 3), "x": page("b", 1, "x", 3)}, "repeated"),
        ({None: page("a", 2, "x", 3), "x": page("b", 0, "y", 3)}, "empty"),
    ):
        with pytest.raises(paged.PageError, match=said):
            ask(pages, paged.PAGE_NUMBERS)
    assert ask({"total": page("", 0, None, 0)}, paged.TOTAL_FIRST) == []
    assert len(ask({None: page("a", 250, "x"), "x": page("b", 1)}, paged.ONE_PAGE)) == 1
    asked = []
    list(paged.scan(lambda r: asked.append(r) or page("", 1, None, 1), paged.TOTAL_FIRST, "t", "2024-02-01", "2024-03-01", "k"))
    assert [(r.only_total, r.first, r.last, r.predicate) for r in asked] == [(True, "2024-02-01", "2024-02-29", "k"), (False, "2024-02-01", "2024-02-29", "k")]


def test_terms_are_pruned_at_the_source():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = paged._PruningReader(lambda r: paged.Page("", 0), paged.CURSORS, {"terms": "a|b|c"})
    rest = list(reader.pushFilters([In(("term",), ("a", "c")), GreaterThan(("n",), 3)]))
    assert [p.term for p in reader.partitions()] == ["a", "c"] and rest == [GreaterThan(("n",), 3)]
    assert list(reader.pushFilters([EqualTo(("term",), "c")])) == [] and [p.term for p in reader.partitions()] == ["c"]


def test_the_predicate_reaches_the_source():
    from pyspark.sql.datasource import EqualTo

    asked = []
    reader = paged._PruningReader(lambda r: asked.append(r.predicate) or paged.Page("b", 1), paged.CURSORS, {"terms": "a|b"})
    wanted = EqualTo(("predicate",), "x|y")
    assert list(reader.pushFilters([wanted])) == [wanted]
    assert [row[-1] for p in reader.partitions() for row in reader.read(p)] == ["x|y"] * 2 and asked == ["x|y"] * 2


def test_volumes_and_single_items(spark):
    counts = {("a", "2024-01-01", "2024-01-31"): 3, ("a", "2024-02-01", "2024-02-29"): 0}
    windows = [("a", "2024-01-01", "2024-02-01", 7), ("a", "2024-02-01", "2024-03-01", 8), (None, "2024-02-01", "2024-03-01", 9), ("a", None, "2024-03-01", None)]
    frame = spark.createDataFrame(windows, "term string, first string, last string, mark int")
    found = paged.volumes(frame, lambda r: paged.Page("", 0, None, counts[r.term, r.first, r.last] if r.only_total else -1))
    assert sorted((r["mark"] or 0, r["total"]) for r in found.collect()) == [(0, None), (7, 3), (8, 0), (9, None)]
    assert paged.volumes(frame.limit(0), lambda r: paged.Page("", 0)).count() == 0
    ids = spark.createDataFrame([("1",), ("2",), ("1",), (None,)], "id string")
    assert rows(paged.items(ids, {"1": "body"}.get)) == [("1", "body"), ("2", None)]
