from __future__ import annotations

from tidemark.streaming.attention import current, daily_attention, remove_old, sessions, upsert_batches

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for name, f in (("daily", daily_attention), ("sessions", sessions)):
        q = f(stream).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        a, b = spark.table(name), f(events)
        rounded = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())
        assert rounded(a) == rounded(b)


def test_current_rows_and_replay(spark, tmp_path):
    write = upsert_batches(str(tmp_path / "current"), ["k"], "v")
    make = lambda r: spark.createDataFrame(r, "k int, v int, x string")
    for number, batch in enumerate(([(1, 1, "a"), (2, 5, "b")], [(1, 3, "c"), (2, 4, "late")])):
        write(make(batch), number)
        write(make(batch), number)
    now = current(spark, str(tmp_path / "current"), make([(1, 1, "a")]).schema)
    assert sorted(tuple(r) for r in now.select("k", "v", "x").collect()) == [(1, 3, "c"), (2, 5, "b")]
    # a batch that ended before its pointer leaves the state as it was, and its replay repairs it
    (tmp_path / "current" / "pointers" / f"{1:012d}" / "_SUCCESS").unlink()
    before = current(spark, str(tmp_path / "current"), now.schema)
    assert sorted(r["v"] for r in before.collect()) == [1, 5]
    write(make([(1, 3, "c"), (2, 4, "late")]), 1)
    assert sorted(r["v"] for r in current(spark, str(tmp_path / "current"), now.schema).collect()) == [3, 5]
    # old versions go, those that the kept pointers name stay
    for number in (2, 3, 4):
        write(make([(1, 10 + number, "d")]), number)
    want = sorted(tuple(r) for r in current(spark, str(tmp_path / "current"), now.schema).select("k", "v", "x").collect())
    assert remove_old(spark, str(tmp_path / "current"), 1) > 0 and remove_old(spark, str(tmp_path / "current"), 1) == 0
    assert sorted(tuple(r) for r in current(spark, str(tmp_path / "current"), now.schema).select("k", "v", "x").collect()) == want == [(1, 14, "d"), (2, 5, "b")]
    assert len(list((tmp_path / "current" / "pointers").glob("0*"))) == 1
