"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "foliant", **conf: str) -> SparkSession:
    """A session with adaptive execution (partition coalescing and skew joins) and UTC times."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
