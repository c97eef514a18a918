"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the marts compile several hundred classes; with the default of 100 they are
    # evicted and compiled again within a single query
    "spark.sql.codegen.cache.maxEntries": "5000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A session in one process, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("featuremart")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return builder.config("spark.driver.memory", memory).getOrCreate()
