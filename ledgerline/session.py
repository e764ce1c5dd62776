"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster, master and sizes come from the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
