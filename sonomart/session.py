"""Session defaults for jobs that do not bring their own SparkSession."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot partition is worth an extra shuffle when one key may hold a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark broadcasts a side only when its measured size is below these limits.
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites on every column cost more driver time than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.files.maxPartitionBytes": str(128 << 20),
}


def get_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
