"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correct results need only the time zone; the rest lets Catalyst re-plan at run time, split skewed
# join partitions even where that costs an extra exchange, and keep shuffle tasks at about 128 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def use_settings(spark: SparkSession) -> None:
    """Apply the settings for re-planning at run time to a session that a cluster has made."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive.") and not key.endswith("advisoryPartitionSizeInBytes"):
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyloom")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
