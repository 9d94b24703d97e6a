"""What a grant leaves behind after its revocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions import statements as texts
from grantline.settings import Settings


def residual_privileges(grants: DataFrame, settings: Settings) -> DataFrame:
    """Per access key the grant statements that no revoke statement takes back.

    A report: revocation leaves warehouse and all-schema usage in force.
    """
    parts = (F.col("snowflake_role"), F.col("snowflake_database"), F.col("snowflake_schema"))
    granted = texts.grant_statements(*parts, settings.default_warehouse)
    undone = F.transform(
        texts.revoke_statements(*parts),
        lambda s: F.replace(
            F.replace(s, F.lit("REVOKE "), F.lit("GRANT ")), F.lit(" FROM ROLE "), F.lit(" TO ROLE ")
        ),
    )
    return grants.select(
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        F.explode(F.array_except(granted, undone)).alias("statement"),
    )


def with_references(due: DataFrame, staying: DataFrame) -> DataFrame:
    """``due`` with the number of staying grants that need what its revoke would take.

    Every grant of a role in a database needs the usage of the database (``database_refs``); one
    without a schema needs the usage of every schema there (``schema_refs``). Counted
    per role and database by an aggregate, so that a role with many grants collapses before
    the shuffle.
    """
    counted = staying.groupBy("snowflake_role", "snowflake_database").agg(
        F.count("*").alias("database_refs"),
        F.count_if(F.coalesce("snowflake_schema", F.lit("")) == "").alias("schema_refs"),
    )
    return due.join(counted, ["snowflake_role", "snowflake_database"], "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("database_refs", "schema_refs")}
    )


def unshared(plan: Column) -> Column:
    """The statements of a revoke plan that take nothing another grant needs.

    A plan ends with the usage of the database, and before it, if it has a schema, that of the
    schema.
    """
    nothing = F.array().cast("array<string>")
    size = F.size(plan)
    schema = F.when(F.col("schema_refs") == 0, F.slice(plan, size - 1, F.lit(1))).otherwise(nothing)
    database = F.when(F.col("database_refs") == 0, F.slice(plan, size, F.lit(1))).otherwise(nothing)
    tables = F.when(size > 1, F.concat(F.slice(plan, F.lit(1), size - 2), schema)).otherwise(nothing)
    return F.concat(tables, database)
