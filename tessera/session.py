"""The session that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "tessera", **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; `conf` keys use _ for dots where a dot can't be written."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
