"""Session for local runs and tests; on a cluster the submitted configuration rules."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "tallyloom", cores: int | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
