"""Small frames for tests."""

from pyspark.sql import functions as F

from grantline import schemas
from grantline.functions import forms
from tests.conftest import AS_OF_MS

HOUR = 3_600_000
DAY = 86_400_000

FLAT = (
    "seq long, urn string, request_type string, status string, result string, note string, "
    "resource string, requestor_urn string, created_ms long, snowflake_role string, "
    "snowflake_database string, snowflake_schema string, duration_raw string, "
    "requestor_email string"
)


def flat_row(urn, seq=0, **values):
    row = {
        "seq": seq,
        "urn": urn,
        "request_type": "WORKFLOW_FORM_REQUEST",
        "status": "COMPLETED",
        "result": "ACCEPTED",
        "note": "Looks good",
        "resource": "urn:li:dataset:orders",
        "requestor_urn": "urn:li:corpuser:alice",
        "created_ms": AS_OF_MS - HOUR,
        "snowflake_role": "ANALYST_ROLE",
        "snowflake_database": "PROD",
        "snowflake_schema": "SALES",
        "duration_raw": "30",
        "requestor_email": "alice@example.com",
    }
    row.update(values)
    return tuple(row[c.split()[0]] for c in FLAT.split(", "))


def flat(spark, *rows):
    """Flat requests as the flattening operator gives them."""
    none = F.array().cast("array<string>")
    return spark.createDataFrame(list(rows), FLAT).withColumns(
        {
            "access_duration_days": forms.duration_days(F.col("duration_raw")),
            "assigned_users": none,
            "assigned_groups": none,
        }
    )


def properties(spark, *rows):
    """(username, property, value) rows."""
    return spark.createDataFrame(list(rows), "username string, property string, value string")


def grants(spark, *rows):
    """(role, database, schema, urn, email, granted_ms, expires_ms, revoked_ms) rows."""
    frame = spark.createDataFrame(
        list(rows),
        "snowflake_role string, snowflake_database string, snowflake_schema string, "
        "latest_action_request_urn string, requestor_email string, g long, e long, r long",
    )
    return frame.select(
        *frame.columns[:5],
        F.timestamp_millis("g").alias("granted_at"),
        F.timestamp_millis("e").alias("expires_at"),
        F.timestamp_millis("r").alias("revoked_at"),
    )


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def no_errors(spark):
    return empty(spark, schemas.PROVISIONING_ERRORS)


def no_sla(spark):
    return empty(spark, schemas.SLA_NOTIFICATIONS)


def rows_of(frame, *columns):
    return sorted(
        (tuple(r[c] for c in columns) for r in frame.select(*columns).collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def column(frame, name):
    return [r[0] for r in frame.select(name).collect()]
