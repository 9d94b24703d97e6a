"""Change events and the requests they point to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators.requests import first_per_urn, lookup, slim
from grantline.settings import CHANGE_ASPECT, CHANGE_ENTITY_TYPE, CHANGE_EVENT_TYPE


def routed_events(events: DataFrame) -> DataFrame:
    """Status changes of requests; works on static and streaming frames."""
    return events.filter(
        (F.col("event_type") == CHANGE_EVENT_TYPE)
        & (F.col("entity_type") == CHANGE_ENTITY_TYPE)
        & (F.col("aspect_name") == CHANGE_ASPECT)
        & (F.col("entity_urn") != "")
    )


def changed_urns(routed: DataFrame) -> DataFrame:
    """``(urn, first_event, events)``: one row per URN, however often it was delivered."""
    return routed.groupBy(F.col("entity_urn").alias("urn")).agg(
        F.min("event_id").alias("first_event"), F.count("*").alias("events")
    )


def matched_requests(changed: DataFrame, flat: DataFrame) -> DataFrame:
    """Current requests of the changed URNs, ``seq`` replaced by the event order.

    Copies in a listing collapse before they are shuffled.
    """
    found = first_per_urn(slim(flat)).join(changed, "urn")
    return found.withColumn("seq", F.col("first_event")).drop("first_event")


def unmatched_urns(changed: DataFrame, flat: DataFrame) -> DataFrame:
    """Changed URNs without a request."""
    known = lookup(flat, changed).select("urn").distinct()
    return changed.join(known, "urn", "left_anti")
