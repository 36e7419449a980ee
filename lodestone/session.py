"""Session construction for local runs, tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "lodestone", cores: int | str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with UTC clock and adaptive execution; a cluster brings its own settings."""
    master = f"local[{cores or os.environ.get('BENCH_CPUS', '8')}]"
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODESTONE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
