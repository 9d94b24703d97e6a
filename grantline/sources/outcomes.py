"""Outcomes of statements, as the system that executed them reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantline import schemas


def read_outcomes(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Typed outcome rows; nothing is inferred."""
    return spark.read.schema(schemas.STATEMENT_OUTCOMES).format(source).load(path)
