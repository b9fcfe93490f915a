"""Local session used by tests, tools and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("keyferry")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
