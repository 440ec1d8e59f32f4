"""Spark session settings used by tests and benches.

On a cluster the submitter owns these; nothing in the package depends on them
except UTC as session time zone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small local data would otherwise end in fewer partitions than cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.ui.enabled": "false",
    # Building a query is otherwise slowed by a call-site lookup per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "riskloom", memory: str = "12g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
