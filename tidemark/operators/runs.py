"""Scan requests and work queues as values: freeze or resume, leases with fencing, attempts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def freeze_or_resume(requests: DataFrame, scans: DataFrame) -> DataFrame:
    """request_id, scan_id, action (``resume`` or ``new``) of each request.

    requests: request_id, request_key (identity of source and policy), source, scan_id (null if not
    asked for by name). scans: scan_id, request_key, source, status. A named scan is resumed whatever
    its status, and a request that names one with another source, or an unknown one, raises. Others
    resume the least incomplete scan of their key; without one the request's own id names a new scan.
    """
    known = scans.select(F.col("scan_id").alias("_known"), F.col("source").alias("_source"))
    named = requests.where("scan_id is not null").join(known, F.col("scan_id") == F.col("_known"), "left")
    wrong = F.when(F.col("_known").isNull(), "an unknown scan is asked for").when(~F.col("source").eqNullSafe(F.col("_source")), "a scan cannot change its source request")
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong).cast(dict(scans.dtypes)["scan_id"])).otherwise(F.col("_known"))
    by_name = named.select("request_id", checked.alias("scan_id"), F.lit("resume").alias("action"))
    unfinished = scans.where("status <> 'complete'").groupBy("request_key").agg(F.min("scan_id").alias("_open"))
    others = requests.where("scan_id is null").drop("scan_id").join(unfinished, "request_key", "left")
    by_key = others.select("request_id", F.coalesce("_open", F.col("request_id").cast(dict(scans.dtypes)["scan_id"])).alias("scan_id"), F.when(F.col("_open").isNull(), "new").otherwise("resume").alias("action"))
    return by_name.unionByName(by_key)


def runnable(now: dt.datetime, retry_before: dt.datetime, max_attempts: int) -> Column:
    """Pending, or with an expired lease, or failed long enough ago with attempts left."""
    failed = (F.col("status") == "failed") & (F.col("attempts") < max_attempts) & (F.col("updated_at") < F.lit(retry_before))
    return (F.col("status") == "pending") | ((F.col("status") == "claimed") & (F.col("claimed_until") < F.lit(now))) | failed


def claim(queue: DataFrame, group: str, now: dt.datetime, lease_seconds: int, retry_before: dt.datetime, max_attempts: int) -> DataFrame:
    """The queue after each group's worker has leased its oldest runnable row: status, attempts, fence and lease end move.

    queue: id, group, status, attempts, fence, claimed_until, updated_at.
    """
    first = queue.where(runnable(now, retry_before, max_attempts)).groupBy(group).agg(F.min("id").alias("_id"))
    mine = F.col("id") == F.col("_id")
    moved = {"status": F.lit("claimed"), "attempts": F.col("attempts") + 1, "fence": F.col("fence") + 1, "claimed_until": F.lit(now + dt.timedelta(seconds=lease_seconds)), "updated_at": F.lit(now)}
    out = queue.join(first, group, "left").withColumn("_mine", F.coalesce(mine, F.lit(False)))
    return out.withColumns({c: F.when(F.col("_mine"), v.cast(dict(queue.dtypes)[c])).otherwise(F.col(c)) for c, v in moved.items()}).select(*queue.columns)


def settle(queue: DataFrame, results: DataFrame, now: dt.datetime) -> DataFrame:
    """The queue after results (id, fence, outcome) came in: complete, failed, or released with its attempt given back.

    A result whose fence is not the row's current one comes from a worker that lost its lease and changes nothing.
    """
    known = F.expr("outcome in ('complete', 'failed', 'released')")
    got = results.where(known).select(F.col("id").alias("_id"), F.col("fence").alias("_fence"), "outcome").dropDuplicates(["_id", "_fence"])
    out = queue.join(got, (F.col("id") == F.col("_id")) & (F.col("fence") == F.col("_fence")) & (F.col("status") == "claimed"), "left")
    done = F.col("outcome").isNotNull()
    kinds = dict(queue.dtypes)
    moved = {
        "status": F.when(F.col("outcome") == "released", "pending").otherwise(F.col("outcome")),
        "attempts": F.col("attempts") - F.when(F.col("outcome") == "released", 1).otherwise(0),
        "claimed_until": F.lit(None).cast(kinds["claimed_until"]),
        "updated_at": F.lit(now),
    }
    return out.withColumns({c: F.when(done, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in moved.items()}).select(*queue.columns)


def backoff(attempt: Column, base: float, most: float, jitter: Column) -> Column:
    """Seconds to wait before an attempt (from 1): base doubled each time, up to most, times a jitter from 0 to 1 added to one half."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most)) * (F.lit(0.5) + jitter / 2)


def drain(queue: DataFrame, recent: Column, rotating: Column) -> DataFrame:
    """The rows that a run takes from its two queues by position; queue: queue, position. recent and rotating are their units."""
    return queue.where(F.col("position") <= F.when(F.col("queue") == "recent", recent).otherwise(rotating))


def insert_once(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """stored and those rows whose key it lacks; of new rows with one key the least by all columns stays."""
    order = W.partitionBy(*keys).orderBy(*(c for c in rows.columns if c not in keys)) if len(rows.columns) > len(keys) else W.partitionBy(*keys).orderBy(*keys)
    fresh = rows.join(stored.select(*keys), keys, "left_anti").withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    return stored.unionByName(fresh)
