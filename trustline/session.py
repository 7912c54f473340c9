"""Session settings shared by the bench, the tests and the pipeline."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every deployment wants.  Shuffle parallelism is left to the cluster:
# AQE coalesces downwards from spark.sql.shuffle.partitions, so at 100 TB set it
# to about (shuffled bytes / 256 MB) and let AQE merge what turns out small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that are dealt have wide fixed slots; LZ4 leaves more than twice as much of them.
    "spark.io.compression.codec": "zstd",
    # Skip the per-expression call-site lookup; it dominates the time to build a frame.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def spark_session(app: str = "trustline", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
