"""Current versions as a stream with state per entity: late, equal and undated observations in any order, without recomputing keys.

State is what :func:`tidemark.operators.versions.reconcile` keeps of an entity: its greatest dated observation, its greatest undated
one and the versions seen, as a streaming aggregate. An observation changes the state by maximum and union, which do not depend on
order, so a late old baseline never displaces a newer row, and A, B, A again changes nothing that A, B had settled but what reconcile
changes too. An entity gives a row in each batch that observes it; its last row is the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates


def reconciled(observations: DataFrame) -> DataFrame:
    """A stream of current rows (scope_id, entity_id, version_id, version_ids, conflict, uncertain) with a ``step`` that counts an entity's
    observations so far; observations as for reconcile, ids whole numbers.

    Large states want the RocksDB state store: spark.sql.streaming.stateStore.providerClass. Null ranks count as false or the least number.
    """
    at = F.unix_micros(dates.utc_instant(F.col("updated_date")).cast("timestamp"))
    rows = observations.select(
        F.col("scope_id").cast("string").alias("scope_id"), F.col("entity_id").cast("long").alias("entity_id"), F.col("version_id").cast("long").alias("version_id"),
        at.alias("at"), F.coalesce("is_api", F.lit(False)).alias("is_api"), F.coalesce(F.col("observed_at").cast("long"), F.lit(-(1 << 62))).alias("observed_at"),
    )
    rank = F.struct("is_api", "observed_at", "version_id")
    state = rows.groupBy("scope_id", "entity_id").agg(
        F.max(F.when(F.col("at").isNotNull(), F.struct("at", rank.alias("rank")))).alias("dated"), F.max(F.when(F.col("at").isNull(), rank)).alias("undated"),
        F.sort_array(F.collect_set("version_id")).alias("version_ids"), F.count("*").alias("step"),
    )
    best = F.greatest("dated.rank", "undated")
    return state.select("scope_id", "entity_id", best["version_id"].alias("version_id"), "version_ids", (F.size("version_ids") > 1).alias("conflict"), F.col("undated").isNotNull().alias("uncertain"), "step")


def last_rows(changes: DataFrame) -> DataFrame:
    """The current row of every entity from the stream's rows, as stored by any sink."""
    best = changes.groupBy("scope_id", "entity_id").agg(F.max_by(F.struct("version_id", "version_ids", "conflict", "uncertain"), "step").alias("x"))
    return best.select("scope_id", "entity_id", "x.*")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
