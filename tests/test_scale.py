"""Work that must not grow faster than the input: batches, spread, paging and state."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark import queries
from tidemark.operators import arrow, funding, neighbours
from tidemark.plans import apis
from tests.ports import generated
from tidemark.sources import cursors, files, paged

SF = "/root/testdata/sf0.001"


def test_acquired_files_are_dealt_to_many_tasks_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(files, "HELD", 10)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [(f"n{k}", 2 if k < 10 else 3, sha(f"n{k}")) for k in range(40)] + [("unsized", None, sha("unsized")), ("kept", 4, sha("kept"))]
    manifest = spark.createDataFrame(rows, "name string, bytes long, sha256 string").coalesce(1)
    found = files.acquire(manifest, spark.createDataFrame([("kept", sha("kept"))], "name string, sha256 string"), str.encode)
    got = {r["name"]: (r["content"], r["size"], r["adopted"], r["defect"]) for r in found.collect()}
    assert len(got) == 42 and got["n7"] == (b"n7", 2, False, None) and got["n17"] == (b"n17", 3, False, None)
    assert got["unsized"] == (None, None, False, "size") and got["kept"] == (None, 4, True, None)
    assert found.select(F.spark_partition_id()).distinct().count() > 4


def test_a_served_table_is_paged_from_small_files(spark, monkeypatch):
    monkeypatch.setattr(apis, "SEGMENT", 100)
    orders = {r["o_orderkey"]: (r["o_orderpriority"], str(r["d"])) for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("d")).collect()}
    for numbers in (True, False):
        api = apis._served(spark, SF, "orders", "o_orderpriority", "o_orderkey", 37, day="o_orderdate", word="o_orderstatus", numbers=numbers)
        assert max(pq.read_metadata(p).num_rows for p, _, _ in apis._paths(api.path)) <= 100
        for first, last in (("", ""), ("1995-01-01", "1996-12-31"), ("1995-01-01", ""), ("1999-01-01", "1999-01-01")):
            want = sorted(k for k, (p, d) in orders.items() if p == "1-URGENT" and first <= d <= (last or "9"))
            found = [tuple(r) for r in paged.scan(api, paged.Rules(has_total=True), "1-URGENT", first, last, "")]
            items = [x for r in found for x in json.loads(r[6])["hits"]]
            assert [x["id"] for x in items] == want and all(x["at"]["day"] == orders[x["id"]][1] for x in items)
            assert found[-1][3] == len(want) == api(paged.Request("1-URGENT", first, last, None, "", True)).total
    f_or_o = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderpriority = '5-LOW' and o_orderstatus in ('F', 'O')").count()
    assert api(paged.Request("5-LOW", "", "", None, "F|O", True)).total == f_or_o and api(paged.Request("none", "", "", None, "")).items == 0


def test_bodies_go_on_in_batches_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(paged, "BATCH_BYTES", 1000)
    rows = [("t", k, None, None, 1, k == 9, "x" * 400) for k in range(10)]
    assert [b.num_rows for b in paged.batches(iter(rows))] == [3, 3, 3, 1]


def test_a_headline_is_read_once_by_evenly_dealt_tasks(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    titles = spark.createDataFrame([("Oakmere bags $3 million seed round",)], "title string")
    assert plan(titles.select(funding.extract(F.col("title")).alias("e"))).count("regexp_extract(") < 60  # 190 where groups are made anew for each unit
    articles = spark.range(200).select(F.col("id").alias("article_id"), F.concat(F.lit("House "), "id", F.lit(" raises $100k in a seed round")).alias("title"), F.lit("2024-01-05").cast("timestamp").alias("seen_at")).coalesce(1)
    events, links = funding.events(articles)
    assert "regexp_extract" not in plan(events) + plan(links) and events.count() == links.count() == 200
    assert queries.queries()["str11_extract_events"](spark, SF).select(F.spark_partition_id()).distinct().count() > 4


def test_state_per_entity_takes_no_python_worker(spark, tmp_path):
    from tidemark.streaming.versions import last_rows, reconciled

    seen = spark.range(4000).select(F.lit("s").alias("scope_id"), (F.col("id") % 1000).alias("entity_id"), F.col("id").alias("version_id"), F.lit("2024-01-01").alias("updated_date"), F.lit(True).alias("is_api"), F.lit(0).alias("observed_at"))
    seen.write.parquet(str(tmp_path / "in"))
    stream = reconciled(spark.readStream.schema(seen.schema).parquet(str(tmp_path / "in")))
    assert "Python" not in stream._jdf.queryExecution().analyzed().toString() and "InPandas" not in stream._jdf.queryExecution().analyzed().toString()
    q = stream.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("append").parquet(str(tmp_path / "out")))
    q.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    got = last_rows(spark.read.parquet(str(tmp_path / "out"))).collect()
    assert len(got) == 1000 and all(r["version_ids"] == [r["entity_id"] + 1000 * k for k in range(4)] and r["version_id"] == r["entity_id"] + 3000 for r in got)


def test_a_stream_of_many_pages_has_few_batches_on_executors(spark, tmp_path):
    sizes = {"a": 23, "bb": 0, "c": 997}
    spark.dataSource.register(cursors.cursor_stream("cursor_spread", generated(sizes.get, 5, False)))
    for once in (True, False):  # stopped after its first batch, the query goes on
        stream = spark.readStream.format("cursor_spread").options(terms="a|bb|c", cursors=str(tmp_path / "cursors")).load()
        out = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check"))
        q = (out.trigger(once=True) if once else out).start()
        if once:
            q.awaitTermination(60)
            assert spark.read.schema(paged.SCHEMA).parquet(str(tmp_path / "out")).count() == 3
        else:
            q.processAllAvailable()
            q.stop()
    rows = spark.read.schema(paged.SCHEMA).parquet(str(tmp_path / "out")).orderBy("term", "page").collect()
    assert [(r["term"], r["page"]) for r in rows] == [("a", k) for k in range(5)] + [("bb", 0)] + [("c", k) for k in range(200)]
    assert [x["id"] for r in rows if r["term"] == "c" for x in json.loads(r["body"])["hits"]] == list(range(997))
    assert len(list((tmp_path / "check" / "commits").glob("[0-9]*"))) < 15


def test_vectors_of_floats_are_shuffled_as_floats(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    shuffled, keyed = [], arrow.keyed
    monkeypatch.setattr(arrow, "keyed", lambda df, *more: shuffled.append(dict(df.dtypes)["x"]) or keyed(df, *more))
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 8)).astype(np.float32) * 3
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "idx long, vector array<float>").repartition(3)
    got = {(r["id"], r["rank"]): r["distance"] for r in neighbours.neighbours(df, 5).collect()}
    assert set(shuffled) == {"array<float>"}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    d = np.sort(1 - u @ u.T + np.where(np.eye(300) > 0, 9, 0), axis=1)[:, :5]
    assert np.mean([got[i, k + 1] <= d[i, k] + 1e-9 for i in range(300) for k in range(5)]) > 0.9 and min(got[i, 1] - d[i, 0] for i in range(300)) > -1e-9
