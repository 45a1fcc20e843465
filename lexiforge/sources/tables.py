"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than there are cores, dealt over them before heavy row-local work.

    A file of one row group is one task whatever its splits. Tables of more splits
    stay as they are, without a shuffle; so this never moves much.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < 4 * cores and len(df.inputFiles()) < cores
    return df.repartition(cores) if few else df
