"""Session defaults used by tests, the benchmark and scripts (a cluster brings its own)."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session with the defaults above."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lontar")
    conf = DEFAULTS | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(shuffle_partitions)} | extra
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
