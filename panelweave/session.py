"""Session settings used by the bench, the tests and stand-alone jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "panelweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution on and a fixed time zone.

    On a cluster leave `shuffle_partitions` unset and size
    `spark.sql.adaptive.coalescePartitions.initialPartitionNum` in the submit
    configuration: adaptive execution then merges small shuffle partitions and
    splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
