"""Notification rows: recipients, subject and the values a mail shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions import clock
from grantline.functions.identity import non_empty
from grantline.functions.text import fill
from grantline.operators import statements
from grantline.settings import ESCALATION, WARNING, Settings

# Subjects, with the names of the two systems and the hours filled in.
APPROVAL_SUBJECT = "✅ Your {catalog} access request has been approved"
DENIAL_SUBJECT = "❌ Your {catalog} access request has been denied"
WARNING_SUBJECT = "⚠️ Action required: access request pending for {hours}h"
ESCALATION_SUBJECT = "🚨 Escalation: access request pending {hours}h — immediate action required"
FAILURE_SUBJECT = "⚠️ {catalog} access request could not be provisioned"
REVOCATION_SUBJECT = "🔒 Your {target} access has expired and been revoked"

# What mails show where a value is missing.
NOTHING = "—"
ALL_SCHEMAS_TEXT = "(all schemas)"
INDEFINITE = "Indefinite"
NO_REASON = "No reason provided."

NOTICE_COLUMNS = ["type", "urn", "to", "cc", "subject", "payload", "deliverable"]


def _or(column: str, fallback: Column | str) -> Column:
    other = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.coalesce(non_empty(F.col(column)), other)


def _notice(
    rows: DataFrame,
    kind: Column,
    email: str,
    subject: Column,
    payload: dict[str, Column],
    cc: Column | None = None,
) -> DataFrame:
    """A row without a recipient is kept and marked as not deliverable."""
    address = non_empty(F.col(email))
    nobody = F.array().cast("array<string>")
    to = F.when(address.isNotNull(), F.array(address)).otherwise(nobody)
    entries = [part for name, value in payload.items() for part in (F.lit(name), value)]
    return rows.select(
        kind.alias("type"),
        "urn",
        to.alias("to"),
        (nobody if cc is None else cc).alias("cc"),
        subject.alias("subject"),
        F.create_map(*entries).alias("payload"),
        address.isNotNull().alias("deliverable"),
    )


def duration_text(days: Column) -> Column:
    return F.when(days != 0, F.concat(days.cast("string"), F.lit(" days"))).otherwise(
        F.lit(INDEFINITE)
    )


def approval(granted: DataFrame, settings: Settings) -> DataFrame:
    """Shows form values only, not the resolved role or address."""
    return _notice(
        granted,
        F.lit("approval"),
        "requestor_email",
        F.lit(APPROVAL_SUBJECT.format(catalog=settings.catalog_name)),
        {
            "resource": _or("resource", NOTHING),
            "database": _or("snowflake_database", NOTHING),
            "schema": _or("snowflake_schema", ALL_SCHEMAS_TEXT),
            "role": _or("snowflake_role", NOTHING),
            "duration": duration_text(F.col("access_duration_days")),
            "note": F.coalesce("note", F.lit("")),
            "statements": F.array_join(statements.grant_report(settings), "\n"),
        },
    )


def denial(denied: DataFrame, settings: Settings) -> DataFrame:
    return _notice(
        denied,
        F.lit("denial"),
        "requestor_email",
        F.lit(DENIAL_SUBJECT.format(catalog=settings.catalog_name)),
        {"resource": _or("resource", NOTHING), "note": _or("note", NO_REASON)},
    )


def sla(breaches: DataFrame, settings: Settings) -> DataFrame:
    """Warning or escalation, to the requestor; escalations with the leads in copy."""
    hours = clock.whole_hours(F.col("pending_hours")).cast("string")
    escalated = F.col("sla_class") == ESCALATION
    leads = F.array(*[F.lit(a) for a in settings.escalation_recipients]).cast("array<string>")
    subject = F.when(escalated, fill(ESCALATION_SUBJECT, hours=hours)).otherwise(
        fill(WARNING_SUBJECT, hours=hours)
    )
    return _notice(
        breaches,
        F.when(escalated, F.lit(ESCALATION)).otherwise(F.lit(WARNING)),
        "requestor_email",
        subject,
        {
            "resource": _or("resource", F.col("urn")),
            "hours": hours,
            "assignees": F.when(escalated, _or("requestor_email", NOTHING)),
            "link": F.col("urn"),
        },
        F.when(escalated, leads).otherwise(F.array().cast("array<string>")),
    )


def failure(failed: DataFrame, settings: Settings) -> DataFrame:
    return _notice(
        failed,
        F.lit("failure"),
        "requestor_email",
        F.lit(FAILURE_SUBJECT.format(catalog=settings.catalog_name)),
        {
            "resource": _or("resource", NOTHING),
            "database": _or("snowflake_database", NOTHING),
            "schema": _or("snowflake_schema", ALL_SCHEMAS_TEXT),
            "error": F.col("message"),
            "request": F.col("urn"),
        },
    )


def revocation(revoked: DataFrame, settings: Settings) -> DataFrame:
    """``revoked`` has the columns of the grants table."""
    named = revoked.withColumn("urn", F.col("latest_action_request_urn"))
    return _notice(
        named,
        F.lit("revocation"),
        "requestor_email",
        F.lit(REVOCATION_SUBJECT.format(target=settings.target_name)),
        {
            "database": F.col("snowflake_database"),
            "schema": _or("snowflake_schema", ALL_SCHEMAS_TEXT),
            "role": F.col("snowflake_role"),
            "request": F.col("urn"),
        },
    )
