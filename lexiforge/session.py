"""Session defaults."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that every query here assumes; cluster sizing stays with the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(cores: int | str | None = None, **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass no master and use spark-submit."""
    cores = cores or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lexiforge")
    conf = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(cores if str(cores).isdigit() else 8),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
