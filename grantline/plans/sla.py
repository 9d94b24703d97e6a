"""SLA pass: remind and escalate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from grantline.operators import guards, notices, requests, sla
from grantline.settings import Settings
from grantline.state import journal as j


@dataclass(frozen=True)
class Notified:
    breaches: DataFrame
    records: DataFrame
    notifications: DataFrame


def due(flat: DataFrame, sla_notifications: DataFrame, settings: Settings) -> DataFrame:
    """Breaches not yet notified, one per request."""
    pending = requests.pending_requests(flat).select(
        "seq", "urn", "created_ms", "requestor_email", "resource"
    )
    return guards.not_notified(
        requests.first_per_urn(sla.breaches(pending, settings)), sla_notifications
    )


def settle(breaches: DataFrame, settings: Settings) -> Notified:
    """A breach without an address is recorded as well, though no mail can go out."""
    return Notified(
        breaches=breaches,
        records=j.sla_rows(breaches, settings),
        notifications=notices.sla(breaches, settings),
    )
