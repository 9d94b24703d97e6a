"""SLA classes of pending requests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.functions import clock
from grantline.settings import ESCALATION, HOUR_MS, WARNING, Settings


def classify(pending: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``pending_hours`` and ``sla_class`` (null inside the SLA).

    Bounds are inclusive; past the escalation bound no warning is due any more.
    Rows without a creation time are left out.
    """
    hours = F.col("pending_hours")
    return (
        pending.filter(F.col("created_ms") != 0)
        .withColumn("pending_hours", clock.pending_hours(settings.as_of_ms, F.col("created_ms")))
        .withColumn(
            "sla_class",
            F.when(hours >= settings.escalation_after_hours, F.lit(ESCALATION)).when(
                hours >= settings.warning_after_hours, F.lit(WARNING)
            ),
        )
    )


def breaches(pending: DataFrame, settings: Settings) -> DataFrame:
    """Requests past a bound. The scan reads those created early enough only."""
    shortest = min(settings.warning_after_hours, settings.escalation_after_hours)
    # A millisecond more than needed: the class itself decides on fractions of hours.
    latest = math.floor(settings.as_of_ms - shortest * HOUR_MS) + 1
    old = pending.filter(F.col("created_ms") <= latest)
    return classify(old, settings).filter(F.col("sla_class").isNotNull())
