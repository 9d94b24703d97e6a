"""Live pass: act on the requests whose status changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import decisions, events, notices, requests
from grantline.settings import Settings
from grantline.state.store import State


def changes(event_rows: DataFrame) -> DataFrame:
    """``(urn, first_event, events)`` of the status changes among the events."""
    return events.changed_urns(events.routed_events(event_rows))


def decide(
    changed: DataFrame,
    found: DataFrame,
    state: State,
    user_properties: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One decision per changed request, however many events named it.

    ``found`` holds the current requests of those URNs, nested or flat; requests that
    did not change are ignored. Looking them up before their forms are unpacked keeps
    the work in proportion to the batch.
    """
    flat = requests.flatten(found, settings) if "params" in found.columns else found
    # Of the history only the batch's URNs matter; the semi-joins filter it first.
    wanted = changed.select("urn")
    errors = state.provisioning_errors.join(
        wanted, F.col("action_request_urn") == F.col("urn"), "left_semi"
    )
    return decisions.live_decisions(
        events.matched_requests(changed, flat),
        state.grants,
        state.granted_urns.join(wanted, "urn", "left_semi"),
        errors,
        user_properties,
        settings,
    )


def denials(decided: DataFrame, sent: DataFrame, settings: Settings) -> DataFrame:
    """Denial mails.

    ``sent`` holds the notifications of earlier runs. Without dedup there is one
    mail per event, redelivered ones included.
    """
    denied = decided.filter(F.col("decision") == decisions.DENY)
    if settings.dedup_denials:
        mailed = sent.filter(F.col("type") == "denial").select("urn")
        known = mailed.join(denied.select("urn"), "urn", "left_semi")
        return notices.denial(denied.join(known, "urn", "left_anti"), settings)
    repeated = denied.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("events"))))
    return notices.denial(repeated, settings)
