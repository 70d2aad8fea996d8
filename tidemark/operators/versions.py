"""Versions of an entity: latest per key, reconciliation of observations, conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.functions import dates


def latest(observations: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that is greatest by the given columns, each descending."""
    w = W.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return observations.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_page_time(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """observed_at becomes the latest page end of the same run and source, where there is one."""
    ends = pages.groupBy("run_id", "source_id").agg(F.max("ended_at").alias("_end"))
    return observations.join(ends, ["run_id", "source_id"], "left").withColumn("observed_at", F.coalesce("_end", "observed_at")).drop("_end")


def reconcile(observations: DataFrame) -> DataFrame:
    """One current version per (scope_id, entity_id).

    observations: scope_id, entity_id, version_id, updated_date (text), is_api, observed_at.
    Rows whose parsed instant is below the entity's greatest are out; of the rest the greatest by
    (is_api, observed_at, version_id) wins. ``conflict``: more than one version seen;
    ``uncertain``: some row has no parsable instant. One aggregation, so one shuffle; no window.
    """
    keys = ["scope_id", "entity_id"]
    order = ["is_api", "observed_at", "version_id"]
    rows = observations.withColumn("_at", dates.utc_instant(F.col("updated_date")))
    dated = F.max(F.when(F.col("_at").isNotNull(), F.struct("_at", *order)))
    undated = F.max(F.when(F.col("_at").isNull(), F.struct(*order)))
    out = rows.groupBy(*keys).agg(dated.alias("dated"), undated.alias("undated"), F.sort_array(F.collect_set("version_id")).alias("version_ids"))
    best = F.greatest(F.when(F.col("dated").isNotNull(), F.struct(*(F.col(f"dated.{c}").alias(c) for c in order))), F.col("undated"))
    return out.select(*keys, best["version_id"].alias("version_id"), "version_ids", (F.size("version_ids") > 1).alias("conflict"), F.col("undated").isNotNull().alias("uncertain"))


def unique_current(current: DataFrame) -> DataFrame:
    """entity_id, version_id of the entities with one version in all scopes."""
    return current.groupBy("entity_id").agg(F.min("version_id").alias("version_id"), F.max("version_id").alias("_other")).where("version_id = _other").drop("_other")


def conflicts(current: DataFrame) -> DataFrame:
    """entity_id, version_ids (sorted) of the entities with several."""
    return current.groupBy("entity_id").agg(F.sort_array(F.collect_set("version_id")).alias("version_ids")).where(F.size("version_ids") > 1)


def unprocessed(versions: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Versions without a processing row of the same identity (content-addressed, so a reverted version counts as done)."""
    return versions.join(done.select(*keys), keys, "left_anti")


def row_offsets(rows: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """Row numbers that continue after each run's greatest known one."""
    offset = known.groupBy("run_id").agg(F.max("row_number").alias("_base"))
    own = F.row_number().over(W.partitionBy("run_id").orderBy(*order))
    return rows.withColumn("_own", own).join(offset, "run_id", "left").withColumn("row_number", F.col("_own") + F.coalesce(F.col("_base") + 1, F.lit(1)) - 1).drop("_own", "_base")
