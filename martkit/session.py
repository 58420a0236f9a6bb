"""Session settings the jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(name: str = "martkit", cores: str | None = None, **settings: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    n = cores or os.environ.get("BENCH_CPUS") or "8"
    builder = SparkSession.builder.master(f"local[{n}]").appName(name)
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **settings,
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
