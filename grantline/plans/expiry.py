"""Expiry pass: revoke what has run out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import notices, outcomes, privileges, statements
from grantline.operators.sequence import KEY, schema_key
from grantline.settings import Settings
from grantline.state import journal as j

# A request URN may sit in several rows, so outcomes of revokes go by access key too.
BY = ["urn", *KEY]


@dataclass(frozen=True)
class Revoked:
    journal: DataFrame
    notifications: DataFrame


def expired(grants: DataFrame, settings: Settings) -> DataFrame:
    """Grants to revoke; none where expiry is switched off."""
    rows = j.expired_grants(grants, settings).filter(F.lit(settings.expiry_enabled))
    if not settings.keep_shared_privileges:
        return rows
    return privileges.with_references(rows, j.staying_grants(grants, settings))


def plan(due: DataFrame, settings: Settings) -> DataFrame:
    return statements.revoke_rows(due, settings)


def results(due: DataFrame, outcome_rows: DataFrame, settings: Settings) -> DataFrame:
    """Grants to revoke with their outcome."""
    keyed = due.withColumn("urn", F.col("latest_action_request_urn")).withColumn(
        "snowflake_schema", schema_key(F.col("snowflake_schema"))
    )
    expected = F.size(statements.revoke_plan(settings))
    return outcomes.with_outcomes(keyed, outcome_rows, expected, BY)


def settle(done: DataFrame, settings: Settings, run_id: str) -> Revoked:
    """A grant is revoked when all its statements succeeded; others are tried again."""
    revoked = done.filter(F.col("outcome") == outcomes.GRANTED)
    mails = notices.revocation(revoked, settings)
    return Revoked(
        journal=j.revoke_rows(revoked, settings, run_id),
        notifications=mails.filter(F.lit(settings.revocation_notification)),
    )
