"""A session with the settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("careerpanel")
    builder = builder.config("spark.driver.memory", memory)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
