"""A Spark session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "shiftloom", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """AQE with skew handling, Arrow transfer and UTC; shuffle partitions only if given (AQE coalesces them)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
