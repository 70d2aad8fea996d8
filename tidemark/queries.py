"""All core queries: (spark, sf_dir) -> DataFrame, and the SQL that checks each."""

from __future__ import annotations

from tidemark.plans import apis, attention, corpus, emergence, headlines, ingest, metrics, more, scalar, storage, vectors  # noqa: F401 - they register their queries
from tidemark.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
