"""Rows that need a look, with the reason, instead of a log line.

Most of them are held back, too. Unsafe identifiers are held back only if the setting
``check_identifiers`` is on; otherwise their reason says that they were let through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.functions import forms
from grantline.operators import decisions


def bad_durations(decided: DataFrame) -> DataFrame:
    """Requests whose duration text yields no number of days, or days without a date."""
    undated = (F.col("access_duration_days") != 0) & F.col("expires_at_ms").isNull()
    reason = F.coalesce(
        forms.duration_problem(F.col("duration_raw")),
        F.when(undated, F.lit("duration_out_of_range")),
    )
    return decided.select(
        "urn", reason.alias("reason"), F.col("duration_raw").alias("detail")
    ).filter(F.col("reason").isNotNull())


def without_target(decided: DataFrame) -> DataFrame:
    """Decided requests that lack a role or a database."""
    return decided.filter(F.col("decision") == decisions.SKIP_MISSING).select(
        "urn",
        decisions.missing_reason().alias("reason"),
        F.col("requestor_urn").alias("detail"),
    )


def unsafe_identifiers(decided: DataFrame) -> DataFrame:
    """Requests with names that would need quoting, whatever is decided about them."""
    return decided.filter(decisions.has_target() & ~decisions.safe_identifiers()).select(
        "urn",
        F.lit("unsafe_identifier").alias("reason"),
        F.concat_ws(".", "resolved_role", "snowflake_database", "snowflake_schema").alias(
            "detail"
        ),
    )


def not_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of which no earlier run has stored request and reason."""
    known = stored.select(F.col("urn").alias("known_urn"), F.col("reason").alias("known_reason"))
    same = F.col("urn").eqNullSafe(F.col("known_urn")) & (F.col("reason") == F.col("known_reason"))
    return rows.join(known, same, "left_anti")


def quarantined(decided: DataFrame) -> DataFrame:
    """All rows of one approval pass that need a look."""
    return (
        bad_durations(decided)
        .unionByName(without_target(decided))
        .unionByName(unsafe_identifiers(decided))
    )
