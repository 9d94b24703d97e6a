"""Existence guards against state, as anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators.skew import by_shuffle


def active_grants(grants: DataFrame) -> DataFrame:
    return grants.filter(F.col("revoked_at").isNull())


def not_provisioned(requests: DataFrame, grants: DataFrame) -> DataFrame:
    """Requests whose URN no active grant row carries."""
    held = active_grants(grants).select(F.col("latest_action_request_urn").alias("urn"))
    return requests.join(by_shuffle(held), "urn", "left_anti")


def not_granted_before(requests: DataFrame, granted_urns: DataFrame) -> DataFrame:
    """Requests whose URN was never granted."""
    return requests.join(by_shuffle(granted_urns.select("urn")), "urn", "left_anti")


def not_failed(requests: DataFrame, errors: DataFrame) -> DataFrame:
    """Requests without a recorded permanent failure."""
    failed = errors.select(F.col("action_request_urn").alias("urn"))
    return requests.join(by_shuffle(failed), "urn", "left_anti")


def not_notified(breaches: DataFrame, sla_notifications: DataFrame) -> DataFrame:
    """Breaches ``(urn, sla_class)`` for which no notification is recorded."""
    sent = sla_notifications.select(
        F.col("action_request_urn").alias("urn"),
        F.col("notification_type").alias("sla_class"),
    )
    return breaches.join(by_shuffle(sent), ["urn", "sla_class"], "left_anti")


def flag(rows: DataFrame, urns: DataFrame, name: str) -> DataFrame:
    """Adds a boolean column: does the row's URN occur in ``urns``?"""
    known = urns.select("urn").distinct().withColumn(name, F.lit(True))
    return rows.join(by_shuffle(known), "urn", "left").withColumn(name, F.coalesce(name, F.lit(False)))
