"""Spark session with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    """UTC session with adaptive execution; settings given here win, those of the cluster stay.

    Shuffle partitions are left to the cluster's setting: adaptive execution joins small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
