"""Session settings for jobs of this library."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "trapiche", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with adaptive execution; partition counts are left to it unless given.

    On a cluster `spark.sql.shuffle.partitions` should be a few times the cores, so that
    adaptive execution has partitions to join and skewed ones to split.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
