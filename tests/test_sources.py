"""Snapshot log, file index, footer scans, point sink, cursor stream, state per entity, table function, endpoint pool, payloads."""

from __future__ import annotations

import itertools
import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import payload
from tidemark.operators import packing, vectors, versions
from tests.ports import generated
from tidemark.sources import cursors, file_index, paged, points, row_groups, snapshots

SF = "/root/testdata/sf0.001"


def test_a_retried_run_is_one_run(spark, tmp_path):
    at = str(tmp_path / "log")
    topics, works = spark.range(3).withColumnRenamed("id", "topic"), spark.range(5).withColumnRenamed("id", "work")

    def broken(stage):
        def fail(now):
            if now == stage:
                raise OSError(stage)

        return fail

    assert snapshots.commit({"topics": topics, "works": works}, at, "one") == 1
    with pytest.raises(OSError):
        snapshots.commit({"topics": topics, "works": works}, at, "two", broken("written"))
    assert snapshots.read(spark, at, "topics").count() == 3
    with pytest.raises(OSError):
        snapshots.commit({"topics": topics, "works": works}, at, "two", broken("committed"))
    assert [snapshots.commit({"topics": topics, "works": works}, at, "two") for _ in range(2)] == [2, 2]
    assert {r["run_id"]: r["count"] for r in snapshots.read(spark, at, "works").groupBy("run_id").count().collect()} == {"one": 5, "two": 5}
    assert snapshots.read(spark, at, "works", 1).count() == 5 and snapshots.vacuum(spark, at) == 2 and snapshots.vacuum(spark, at) == 0
    assert snapshots.read(spark, at, "topics").count() == 6
    with pytest.raises(ValueError):
        snapshots.read(spark, at, "labels")


def test_of_two_writers_of_a_version_one_wins_and_the_other_follows(spark, tmp_path):
    at = str(tmp_path / "log")
    assert snapshots._create(spark, at, {"version": 1, "runs": ["a"], "tables": {}})
    assert not snapshots._create(spark, at, {"version": 1, "runs": ["b"], "tables": {}})
    assert snapshots.latest(spark, at)["runs"] == ["a"]
    once = [True]

    def meanwhile(stage):
        if stage == "written" and once.pop():
            once.append(False)
            snapshots.commit({"t": spark.range(2)}, at, "other")

    assert snapshots.commit({"t": spark.range(3)}, at, "own", meanwhile) == 3
    assert snapshots.read(spark, at, "t").count() == 5 and snapshots.latest(spark, at)["runs"] == ["a", "other", "own"]


def test_an_index_opens_few_files_and_loses_no_row(spark, tmp_path):
    at, index = str(tmp_path / "files"), str(tmp_path / "index")
    spark.range(0, 20000).select((F.col("id") * 7 % 20000).alias("k"), F.col("id").alias("v")).repartition(50).write.parquet(at)
    file_index.build(spark, [at], "k", index)
    held = {r["k"]: r["f"] for r in spark.read.parquet(at).select("k", F.col("_metadata.file_path").alias("f")).collect()}
    for value in (0, 77, 19999):
        opened = file_index.candidates(spark, index, value)
        assert held[value] in opened and len(opened) <= 2
        assert [(r["k"], r["filename"]) for r in file_index.lookup(spark, index, [at], "k", value).collect()] == [(value, held[value])]
    assert file_index.lookup(spark, index, [at], "k", 30000).count() == 0
    names = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    names.write.parquet(str(tmp_path / "names"))
    file_index.build(spark, [str(tmp_path / "names")], "k", str(tmp_path / "index2"))
    assert file_index.lookup(spark, str(tmp_path / "index2"), [str(tmp_path / "names")], "k", "b").count() == 1


def test_only_overlapping_row_groups_are_read(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = str(tmp_path / "rows.parquet")
    pq.write_table(pa.table({"id": list(range(8000)), "x": [str(k) for k in range(8000)]}), at, row_group_size=1000)
    found = row_groups.row_range(spark, at, 2100, 2200, ["id"])
    assert found.rdd.getNumPartitions() == 1 and [(r["id"], r["row_number"]) for r in found.collect()] == [(k, k) for k in range(2100, 2200)]
    both = row_groups.row_range(spark, at, 2990, 3010)
    assert both.rdd.getNumPartitions() == 2 and both.count() == 20 and both.columns == ["id", "x", "row_number"]
    assert [g.number for g in row_groups.overlapping(pq.ParquetFile(at).metadata, 999, 1001)] == [0, 1]
    assert row_groups.row_range(spark, at, 9000, 9100).count() == 0


def test_a_failed_task_leaves_no_point(spark, tmp_path):
    at = str(tmp_path / "vectors")
    spark.dataSource.register(points.point_sink("points_test", points.FolderStore(at), 16))
    rows = spark.range(100).select(F.col("id").alias("point"), F.array(F.lit(1.0), F.lit(2.0)).alias("vector"))
    rows.repartition(3).write.format("points_test").mode("append").save()
    bad = F.when(F.col("point") == 77, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("point"))
    with pytest.raises(Exception, match="broken"):
        rows.repartition(3).withColumn("point", bad).write.format("points_test").mode("append").save()
    found = points.published(spark, at)
    assert found.count() == 100 and found.select("point").distinct().count() == 100
    assert max(r["count"] for r in found.groupBy(F.col("_metadata.file_path")).count().collect()) == 16
    rows.limit(0).write.format("points_test").mode("append").save()
    assert points.published(spark, at).count() == 100


def test_a_stopped_cursor_stream_goes_on(spark, tmp_path):
    sizes = {"a": 23, "bb": 0, "c": 7}
    spark.dataSource.register(cursors.cursor_stream("cursor_test", generated(sizes.get, 5, False)))

    def some(batches):
        stream = spark.readStream.format("cursor_test").option("terms", "a|bb|c").load()
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
        until = time.time() + 60
        while len(list((tmp_path / "check" / "commits").glob("[0-9]*"))) < batches and time.time() < until:
            time.sleep(0.1)
        q.stop()

    some(2)
    first = spark.read.schema(paged.SCHEMA).parquet(str(tmp_path / "out")).count()
    assert 0 < first
    some(6)
    rows = spark.read.schema(paged.SCHEMA).parquet(str(tmp_path / "out")).orderBy("term", "page").collect()
    assert [(r["term"], r["page"]) for r in rows] == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("bb", 0), ("c", 0), ("c", 1)]
    ids = [x["id"] for r in rows if r["term"] == "a" for x in json.loads(r["body"])["hits"]]
    assert ids == list(range(23)) and [r["last"] for r in rows] == [False] * 4 + [True] * 2 + [False, True]


def test_state_per_entity_gives_the_batch_result_in_any_order(spark, tmp_path):
    from tidemark.streaming.versions import ROCKSDB, last_rows, reconciled

    rng = random.Random(3)
    schema = "scope_id string, entity_id long, version_id long, updated_date string, is_api boolean, observed_at long"
    rows = [("s", 1, 10, "2024-05-01", True, 5), ("s", 1, 9, "2020-01-01", False, 9), ("s", 1, 11, None, False, 1), ("s", 1, 10, "2024-05-01", False, 99)]  # a late old baseline, an undated one, an equal one
    rows += [("s", 2, v, "2024-01-01", True, k) for k, v in enumerate((1, 2, 1))]  # A, B, A
    rows += [(rng.choice("st"), rng.randint(3, 9), rng.randint(1, 4), rng.choice(["2024-01-01", "2024-02-01T00:00:00Z", "bad", None]), rng.random() < 0.5, rng.randint(0, 5)) for _ in range(60)]
    want = {(r["scope_id"], r["entity_id"]): (r["version_id"], r["version_ids"], r["conflict"], r["uncertain"]) for r in versions.reconcile(spark.createDataFrame(rows, schema)).collect()}
    assert want["s", 1][0] == 10 and want["s", 2][0] == 1
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        rng.shuffle(rows)
        for k, part in enumerate((rows[:30], rows[30:50], rows[50:])):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            q = reconciled(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("append").parquet(str(tmp_path / "out")))
            q.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(180)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    changes = spark.read.parquet(str(tmp_path / "out"))
    got = {(r["scope_id"], r["entity_id"]): (r["version_id"], r["version_ids"], r["conflict"], r["uncertain"]) for r in last_rows(changes).collect()}
    assert got == want
    assert changes.groupBy("scope_id", "entity_id", "step").count().where("count > 1").count() == 0


def test_chunks_from_sql_equal_the_fold(spark):
    rng = random.Random(2)
    rows = [(f"f{k % 4}", k, rng.randint(1, 60)) for k in range(300)]
    df = spark.createDataFrame(rows, "file string, position long, size long").repartition(5)
    df.createOrReplaceTempView("chunk_rows")
    packing.register_chunks(spark)
    got = spark.sql("SELECT * FROM bounded_chunks(max_items => 7, max_size => 200, rows => TABLE(chunk_rows) PARTITION BY file ORDER BY position)")
    want = packing.bounded_chunks(df, "file", "position", "size", 7, 200, 100)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_endpoints_share_a_queue_and_one_may_die():
    seen, most, now, lock = [], [0], [0], threading.Lock()

    def endpoint(name, dies_after=10**9):
        calls = itertools.count()

        def embed(batch):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            try:
                time.sleep(0.01)
                if next(calls) >= dies_after:
                    raise OSError(name)
                if "bad" in batch:
                    raise ValueError("bad")
                with lock:
                    seen.extend((name, t) for t in batch)
                return [[float(len(t))] for t in batch]
            finally:
                with lock:
                    now[0] -= 1

        return embed

    texts = [f"text {k}" for k in range(95)] + ["bad"]
    embed = vectors.pooled([endpoint("a"), endpoint("b", 2), endpoint("c")], concurrency=2, batch=4)
    found = embed(texts)
    assert found == [[float(len(t))] for t in texts[:-1]] + [None] and most[0] == 2
    assert sorted(t for _, t in seen) == sorted(texts[:-1]) and {n for n, _ in seen} == {"a", "b", "c"}
    seen.clear()
    embed(texts[:40])
    assert {n for n, _ in seen} == {"a", "c"}
    with pytest.raises(RuntimeError):
        vectors.pooled([endpoint("x", 1)], 1, 4)(texts[:9])


def test_payload_edges(spark):
    import hashlib

    assert payload.canonical_json('{"a":"\\u0000number 1.50","b":1.50,"c":[1e2,-0.0,{"é":null}]}') == '{"a":"\\u0000number 1.50","b":1.5,"c":[100,0,{"é":null}]}'
    with pytest.raises(ValueError):
        payload.canonical_json("1e999999999")
    df = spark.createDataFrame([("a}b",), ('q"',), ("line\nbreak",)], "e string")
    for r in df.select("e", payload.content_identity(F.col("e"), F.lit("{}")).alias("x"), payload.spaced_object(F.create_map(F.col("e"), F.lit("1"))).alias("o")).collect():
        content = hashlib.sha256(b"{}").hexdigest()
        assert r["x"]["version_id"] == hashlib.sha256(f'["works",{json.dumps(r["e"])},2,"{content}"]'.encode()).hexdigest()
        assert json.loads(r["o"]) == {r["e"]: 1}
