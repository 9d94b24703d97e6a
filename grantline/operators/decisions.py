"""Decisions: what happens to each approved, denied or pending request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.functions import clock, identity
from grantline.operators import guards, requests, roles, sequence
from grantline.settings import Settings

PROVISION = "provision"
SKIP_PROVISIONED = "skip_provisioned"
SKIP_FAILED = "skip_failed"
SKIP_MISSING = "skip_missing_fields"
SKIP_IDENTIFIER = "skip_unsafe_identifier"
SKIP_DURATION = "skip_duration_out_of_range"
DENY = "deny"
IGNORE_TYPE = "ignore_type"
IGNORE_STATUS = "ignore_status"


def has_target() -> Column:
    """Role and database are known after resolution."""
    database = identity.non_empty(F.col("snowflake_database"))
    return F.col("resolved_role").isNotNull() & database.isNotNull()


def safe_identifiers() -> Column:
    """Every name that goes into a statement is a plain identifier."""
    schema = identity.non_empty(F.col("snowflake_schema"))
    return (
        identity.plain_identifier(F.col("resolved_role"))
        & identity.plain_identifier(F.col("snowflake_database"))
        & F.coalesce(identity.plain_identifier(schema), F.lit(True))
    )


def missing_reason() -> Column:
    """Which required field is missing after resolution, else null."""
    role = F.col("resolved_role").isNull()
    database = identity.non_empty(F.col("snowflake_database")).isNull()
    return (
        F.when(role & database, F.lit("missing_role_and_database"))
        .when(role, F.lit("missing_role"))
        .when(database, F.lit("missing_database"))
    )


def _dated(settings: Settings) -> Column:
    return clock.has_expiry_date(settings.as_of_ms, F.col("access_duration_days"))


def can_provision(settings: Settings) -> Column:
    ready = has_target() & _dated(settings)
    if settings.check_identifiers:
        return ready & F.coalesce(safe_identifiers(), F.lit(False))
    return ready


def _error_urns(errors: DataFrame) -> DataFrame:
    return errors.select(F.col("action_request_urn").alias("urn"))


def _active_homes(grants: DataFrame) -> DataFrame:
    return guards.active_grants(grants).select(
        sequence.key_struct("snowflake_role", "snowflake_database", "snowflake_schema").alias(
            "home"
        ),
        F.col("latest_action_request_urn").alias("urn"),
    )


def _resolve_and_flag(
    candidates: DataFrame,
    eligible: Column,
    grants: DataFrame,
    granted_urns: DataFrame,
    errors: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
    respect_failures: bool,
    counted: DataFrame,
) -> DataFrame:
    """Adds the resolved columns and the flags ``provisioned`` and ``failed``.

    Only ``eligible`` rows may be provisioned. The candidates are shuffled by URN
    once, for both flags; ``counted`` serves to find very frequent requestors.
    """
    default_roles = roles.default_roles(user_properties)
    flagged = guards.flag(candidates, _error_urns(errors), "failed")
    may_go = eligible & ~F.col("failed") if respect_failures else eligible
    if settings.guard == "ledger":
        flagged = guards.flag(flagged, granted_urns, "provisioned")
        needed = may_go & ~F.col("provisioned")
        return roles.resolve_roles(flagged, default_roles, settings, needed, counted)
    # Needed several times by the guard, so resolved once.
    resolved = written(
        roles.resolve_roles(flagged, default_roles, settings, eligible, counted), "resolved"
    )
    turns = resolved.filter(eligible).select(
        "urn",
        "seq",
        sequence.key_struct("resolved_role", "snowflake_database", "snowflake_schema").alias(
            "key"
        ),
        (can_provision(settings) & may_go).alias("ready"),
    )
    skipped = sequence.already_latest(turns, _active_homes(grants))
    return guards.flag(resolved, skipped, "provisioned")


def _approved_decision(settings: Settings, respect_failures: bool) -> Column:
    chain = F.when(F.col("provisioned"), F.lit(SKIP_PROVISIONED))
    if respect_failures:
        chain = chain.when(F.col("failed"), F.lit(SKIP_FAILED))
    chain = chain.when(~has_target(), F.lit(SKIP_MISSING))
    chain = chain.when(~_dated(settings), F.lit(SKIP_DURATION))
    if settings.check_identifiers:
        chain = chain.when(~can_provision(settings), F.lit(SKIP_IDENTIFIER))
    return chain.otherwise(F.lit(PROVISION))


def _with_expiry(rows: DataFrame, settings: Settings) -> DataFrame:
    return rows.withColumn(
        "expires_at_ms", clock.expiry_ms(settings.as_of_ms, F.col("access_duration_days"))
    )


def catchup_decisions(
    flat: DataFrame,
    grants: DataFrame,
    granted_urns: DataFrame,
    errors: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per approved request in the window, with a column ``decision``."""
    approved = requests.approved_requests(flat, settings)
    resolved = _resolve_and_flag(
        requests.first_per_urn(requests.slim(approved)),
        F.lit(True),
        grants,
        granted_urns,
        errors,
        user_properties,
        settings,
        True,
        approved,
    )
    decided = resolved.withColumn("decision", _approved_decision(settings, True))
    return _with_expiry(decided, settings)


def live_decisions(
    matched: DataFrame,
    grants: DataFrame,
    granted_urns: DataFrame,
    errors: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per request that changed, with a column ``decision``.

    ``matched`` holds the current requests of the events' URNs, one row each, with
    ``seq`` in event order.
    """
    approved = F.coalesce(requests.is_workflow() & requests.is_approved(), F.lit(False))
    resolved = _resolve_and_flag(
        matched,
        approved,
        grants,
        granted_urns,
        errors,
        user_properties,
        settings,
        settings.check_failures_live,
        matched,
    )
    decision = (
        F.when(~requests.is_workflow(), F.lit(IGNORE_TYPE))
        .when(approved, _approved_decision(settings, settings.check_failures_live))
        .when(requests.is_denied(), F.lit(DENY))
        .otherwise(F.lit(IGNORE_STATUS))
    )
    return _with_expiry(resolved.withColumn("decision", decision), settings)

