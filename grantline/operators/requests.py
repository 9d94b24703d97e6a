"""Scans and projections over request listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions import forms
from grantline.settings import (
    ACCEPTED,
    COMPLETED,
    PENDING,
    REJECTED,
    WORKFLOW_REQUEST,
    Settings,
)


# What decisions, statements, mails and state need of a request.
REQUEST_COLUMNS = [
    "seq",
    "urn",
    "request_type",
    "status",
    "result",
    "note",
    "resource",
    "requestor_urn",
    "created_ms",
    "snowflake_role",
    "snowflake_database",
    "snowflake_schema",
    "duration_raw",
    "access_duration_days",
    "requestor_email",
]


def slim(flat: DataFrame) -> DataFrame:
    """Only the columns later steps use, so that shuffles carry no more."""
    return flat.select(*REQUEST_COLUMNS)


def is_approved() -> Column:
    return (F.col("status") == COMPLETED) & (F.col("result") == ACCEPTED)


def is_denied() -> Column:
    return (F.col("status") == COMPLETED) & (F.col("result") == REJECTED)


def is_pending() -> Column:
    return F.col("status") == PENDING


def is_workflow() -> Column:
    return F.col("request_type") == WORKFLOW_REQUEST


def flatten(requests: DataFrame, settings: Settings) -> DataFrame:
    """One flat row per nested request.

    A missing entity, actor or form gives null columns; the texts stay as given
    (the empty string is a value here).
    """
    ids = settings.fields
    base = requests.select(
        "seq",
        "urn",
        F.col("type").alias("request_type"),
        "status",
        "result",
        F.col("resultNote").alias("note"),
        F.col("entity.urn").alias("resource"),
        F.col("created.actor.urn").alias("requestor_urn"),
        F.col("created.time").alias("created_ms"),
        F.col("dueDate").alias("due_date_ms"),
        F.coalesce("assignedUsers", F.array().cast("array<string>")).alias("assigned_users"),
        F.coalesce("assignedGroups", F.array().cast("array<string>")).alias("assigned_groups"),
        F.col("params.workflowFormRequest.access.expiresAt").alias("form_expires_ms"),
        forms.field_pairs(F.col("params.workflowFormRequest.fields")).alias("_pairs"),
    )
    pairs = F.col("_pairs")
    picked = base.withColumns(
        {
            "snowflake_role": forms.pick(pairs, ids.role),
            "snowflake_database": forms.pick(pairs, ids.database),
            "snowflake_schema": forms.pick(pairs, ids.schema),
            "duration_raw": forms.pick(pairs, ids.duration),
            "requestor_email": forms.pick(pairs, ids.email),
            "justification": forms.pick(pairs, ids.justification),
            "raw": F.coalesce(
                forms.raw_map(pairs), F.create_map().cast("map<string,string>")
            ),
        }
    )
    return picked.withColumn(
        "access_duration_days", forms.duration_days(F.col("duration_raw"))
    ).drop("_pairs")


def approved_requests(flat: DataFrame, settings: Settings) -> DataFrame:
    """Approved workflow requests created inside the lookback window (inclusive)."""
    return flat.filter(
        is_workflow() & is_approved() & (F.col("created_ms") >= settings.since_ms)
    )


def pending_requests(flat: DataFrame) -> DataFrame:
    """Summaries of all pending workflow requests."""
    return flat.filter(is_workflow() & is_pending()).select(
        "seq",
        "urn",
        "created_ms",
        "requestor_urn",
        "requestor_email",
        "resource",
        "assigned_users",
        "assigned_groups",
    )


def lookup(requests: DataFrame, urns: DataFrame) -> DataFrame:
    """Rows of the given URNs (a frame with a column ``urn``), copies included."""
    return requests.join(urns.select("urn").distinct(), "urn", "left_semi")


def first_per_urn(requests: DataFrame, *with_: str) -> DataFrame:
    """One row per URN, the one listed first; rows without a place come last.

    An aggregate, so that copies of one request collapse before the shuffle. Columns ``with_`` follow
    from the URN; with them, rows that are dealt out by both need no further shuffle.
    """
    keys = [*with_, "urn"]
    rest = [c for c in requests.columns if c not in keys]
    place = F.coalesce(F.col("seq"), F.lit(2**63 - 1))
    kept = requests.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_row"))
    return kept.select(*keys, "_row.*")
