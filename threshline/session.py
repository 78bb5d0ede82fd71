"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and ``bench.py``; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threshline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by the path convention ``<dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
