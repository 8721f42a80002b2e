"""Session builder for local runs, tests and the benchmark.

On a cluster the session comes from the submitter; nothing in the package
depends on the settings below other than for speed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "marlstone") -> SparkSession:
    partitions = cores if isinstance(cores, int) else 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
