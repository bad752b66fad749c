"""Session settings for runs of our own (tests, bench, command line)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", memory: str = "12g", name: str = "quern") -> SparkSession:
    """A local session. On a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("QUERN_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
