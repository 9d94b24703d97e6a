"""User properties, one row per (user, property)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantline import schemas


def read_user_properties(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.USER_PROPERTIES).parquet(path)
