"""Session settings that the library expects; every one can be overridden by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def spark_session(name: str = "tapeline", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. `conf` keys use `__` for `.` (`spark__sql__shuffle__partitions="8"`)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
