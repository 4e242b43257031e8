"""Session settings the jobs are written for. Nothing here is needed by the library itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Let Spark pick join sides and partition counts from the sizes it sees at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Wall-clock columns are TIMESTAMP_NTZ; one zone for everything that still needs one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build(app_name: str = "faretide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` uses ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
