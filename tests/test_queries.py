"""Core queries against their SQL at the smallest scale."""

from __future__ import annotations

import decimal
import math

import duckdb
import pytest

from tidemark import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Every query of a few seconds would take minutes together; the driver runs all, these cover each module.
CHOSEN = ["emergence_quadrants", "emergence_observe", "attention_cube", "agg04_coverage_ledger", "win02_reconciliation", "win04_coverage_gaps", "win05_bounded_chunks", "agg18_progress", "flt01_disposition", "flt09_profile_terms", "str01_normalize", "str11_extract_events", "top04_nearest_to_centroid", "ml02_topic_keywords", "agg25_pivot_countries", "top07_refresh_queue", "snk05_upsert", "json04_work_identity", "src08_page_numbers", "src08_volumes", "src08_single_items", "src11_one_page", "stm01_plan_windows", "vec02_representatives", "src15_cached_read"]


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return None if isinstance(v, float) and math.isnan(v) else round(v, 5) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, duck, name):
    df = core.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.sql(core.oracle_sql()[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 25
    assert set(core.oracle_sql()) <= set(core.queries()) <= set(entry.queries())


def test_all_references_are_decoded(spark):
    import hashlib
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in core.queries()["str02_plain_all_references"](spark, SF).collect():
        plain_text = " ".join(html.unescape(re.sub("<[^>]+>", " ", pages[r["page_id"]] or "")).split())
        assert r["h"] == hashlib.md5(plain_text.encode()).hexdigest()


def test_topic_fit_finds_planted_groups(spark):
    from tidemark.operators.topics import KMeansFitter

    rows = [(k, [1.0 + k % 7 * 0.01, 0.0, 0.0] if k % 2 else [0.0, 1.0, k % 5 * 0.01]) for k in range(200)]
    found = KMeansFitter(2, outlier_share=0.1).fit(spark.createDataFrame(rows, "idx int, vector array<double>")).collect()
    groups = {t: {r["idx"] % 2 for r in found if r["topic"] == t} for t in {r["topic"] for r in found}}
    assert len(found) == 200 and sorted(map(len, (groups[t] for t in groups if t >= 0))) == [1, 1]
    assert sum(r["topic"] == -1 for r in found) <= 30


def test_tokenizer_file_counts():
    import glob

    from tidemark.operators.topics import tokenizer_file

    files = sorted(glob.glob("/opt/tokenizers/*.json"))
    if not files:
        pytest.skip("no tokenizer file here")
    assert tokenizer_file(files[0])("two words") >= 2
