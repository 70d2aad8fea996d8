"""Session defaults: UTC, ANSI mode, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators assume; cluster settings are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    return builder.config(map=settings | conf).getOrCreate()
