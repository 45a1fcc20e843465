"""Intermediate tables in the folder that the driver and all executors share.

Long lineages are cut by writing Parquet there, so a lost executor costs the
running stage and never the stages before it. Tables that a lazy result reads
stay until their ``scope`` ends, or until ``clear`` removes all of an application;
if an operator fails, ``tidy`` removes what it has made.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder of our own only where none is set (tests, laptops)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = set_dir.get() if set_dir.isDefined() else None
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "lexiforge-shared")
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lexiforge/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Removes all tables of this application; nothing that reads them may run any more."""
    _delete(spark, _home(spark))


@contextmanager
def scope() -> Iterator[None]:
    """Removes at its end the tables that were made inside."""
    made: list[Staging] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for staging in made:
            staging.drop()


def tidy(operator: Callable) -> Callable:
    """An operator that leaves no tables behind when it fails."""

    @wraps(operator)
    def run(*args, **kwargs):
        made: list[Staging] = []
        _scopes.append(made)
        try:
            out = operator(*args, **kwargs)
        except BaseException:
            for staging in made:
                staging.drop()
            raise
        finally:
            _scopes.remove(made)
        if _scopes:  # the caller's to remove
            _scopes[-1].extend(made)
        return out

    return run


class Staging:
    """Names, writes, rereads and drops the intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{_home(spark)}/{label}-{uuid.uuid4().hex}"
        self.made: list[str] = []
        if _scopes:
            _scopes[-1].append(self)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.made.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads (all of them without names)."""
        for name in names or tuple(self.made):
            _delete(self.spark, f"{self.base}/{name}")
            if name in self.made:
                self.made.remove(name)
        if not self.made:
            _delete(self.spark, self.base)


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small result with checkpoint(); Spark removes the files with the plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
