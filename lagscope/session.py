"""Session settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Shuffles start with many partitions on a cluster; adaptive execution merges the
# small ones, so large days get enough of them and small reports few.
_CLUSTER_PARTITIONS = "2000"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    app: str = "lagscope", master: str | None = None, zone: str = "UTC", **conf: str
) -> SparkSession:
    """A session with adaptive execution.

    Adaptive execution merges small shuffle partitions, turns a join into a
    broadcast once the measured side is small, and splits skewed partitions, so
    no report carries a broadcast hint on data whose size is not fixed.

    ``zone`` gives the hour and day of zoned times and the offset of the points.
    Further settings are named with ``__`` for the dots.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local") and not spark.conf.get(_INITIAL, None):
        spark.conf.set(_INITIAL, _CLUSTER_PARTITIONS)
    return spark
