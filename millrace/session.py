"""A local session for tests and the bench; clusters bring their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
