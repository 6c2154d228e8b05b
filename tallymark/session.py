"""A local session with the settings the tests and the bench use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tallymark", **extra: str) -> SparkSession:
    """Session for one machine. On a cluster, use the cluster's own session instead."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Without a record of the Python line behind every Column, plans are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
