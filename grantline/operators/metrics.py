"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import decisions, statements
from grantline.settings import Settings


def decision_counts(decided: DataFrame, settings: Settings) -> DataFrame:
    """Requests per decision and the statements that follow from them."""
    planned = F.when(
        F.col("decision") == decisions.PROVISION, F.size(statements.grant_plan(settings))
    ).otherwise(F.lit(0))
    return decided.groupBy("decision").agg(
        F.count("*").alias("requests"), F.sum(planned).alias("statements")
    )
