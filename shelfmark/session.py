"""A Spark session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive plans and compressed checkpoints; master and any other setting can be given."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.checkpoint.compress": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.python.filterPushdown.enabled": "true", "spark.python.sql.dataFrameDebugging.enabled": "false", **conf}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
