"""Session settings for benches and tests; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
