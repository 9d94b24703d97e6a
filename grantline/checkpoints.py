"""Intermediate tables that outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may do without it; there a folder under the system's
    temporary directory stands in.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="grantline-"))
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that one job writes and the next reads."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh table and read it back: computed once, lineage cut."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
