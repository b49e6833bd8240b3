"""CTL3: a small local session for tests and measurements.

On a cluster the caller's session is used as it is; adaptive execution sizes
the shuffles there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
