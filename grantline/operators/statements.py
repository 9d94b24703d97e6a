"""Statement rows for the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions import statements as texts
from grantline.operators.privileges import unshared
from grantline.operators.sequence import schema_key
from grantline.settings import Settings


def _numbered(rows: DataFrame, action: str, role: str, plan: Column, dry_run: bool) -> DataFrame:
    return rows.select(
        F.lit(action).alias("action"),
        "urn",
        F.col(role).alias("snowflake_role"),
        "snowflake_database",
        schema_key(F.col("snowflake_schema")).alias("snowflake_schema"),
        F.posexplode(plan).alias("_pos", "statement"),
        F.lit(dry_run).alias("dry_run"),
    ).select(
        "action",
        "urn",
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        (F.col("_pos") + 1).alias("stmt_no"),
        "statement",
        "dry_run",
    )


def _grant_parts() -> tuple[Column, Column, Column]:
    return F.col("resolved_role"), F.col("snowflake_database"), F.col("snowflake_schema")


def grant_plan(settings: Settings) -> Column:
    return texts.grant_statements(*_grant_parts(), settings.default_warehouse)


def grant_report(settings: Settings) -> Column:
    return texts.grant_report(*_grant_parts(), settings.default_warehouse)


def _revoke_parts() -> tuple[Column, Column, Column]:
    return F.col("snowflake_role"), F.col("snowflake_database"), F.col("snowflake_schema")


def revoke_plan(settings: Settings) -> Column:
    plan = texts.revoke_statements(*_revoke_parts())
    return unshared(plan) if settings.keep_shared_privileges else plan


def revoke_report() -> Column:
    return texts.revoke_report(*_revoke_parts())


def grant_rows(provisioned: DataFrame, settings: Settings) -> DataFrame:
    """Numbered statements of requests to provision."""
    return _numbered(
        provisioned, "grant", "resolved_role", grant_plan(settings), settings.dry_run
    )


def grant_report_rows(provisioned: DataFrame, settings: Settings) -> DataFrame:
    return _numbered(
        provisioned, "grant", "resolved_role", grant_report(settings), settings.dry_run
    )


def revoke_rows(expired: DataFrame, settings: Settings) -> DataFrame:
    """Numbered statements of grants to revoke."""
    named = expired.withColumnRenamed("latest_action_request_urn", "urn")
    return _numbered(named, "revoke", "snowflake_role", revoke_plan(settings), settings.dry_run)


def revoke_report_rows(expired: DataFrame, settings: Settings) -> DataFrame:
    named = expired.withColumnRenamed("latest_action_request_urn", "urn")
    return _numbered(named, "revoke", "snowflake_role", revoke_report(), settings.dry_run)
