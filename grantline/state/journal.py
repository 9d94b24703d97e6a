"""The grant journal and the tables it stands for.

Plain files know no MERGE or UPDATE. Each change of a grant is one appended row;
the grants table is the latest row per access key. Inside a run approvals come
before revocations (``phase``), and requests in listing order (``seq``). Runs are
told apart by their clock (``at``, to the millisecond) and, at one instant, by run id. A change
that is recorded after the run that planned it has that run's clock and id in the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantline import schemas
from grantline.functions import clock
from grantline.functions.identity import non_empty
from grantline.operators.sequence import KEY, schema_key
from grantline.settings import HOUR_MS, Settings

GRANT = "grant"
REVOKE = "revoke"
APPROVAL_PHASE = 0
EXPIRY_PHASE = 1


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.to(schemas.JOURNAL)


def _planned(rows: DataFrame, settings: Settings) -> tuple[Column, Column]:
    """Clock and id of the run that planned a change; the id is null if it also records it."""
    now = clock.as_of_exact(settings.as_of_ms)
    if "planned_run" not in rows.columns:
        return now, F.lit(None).cast("string")
    return F.coalesce("planned_at", now), F.col("planned_run")


def grant_rows(granted: DataFrame, settings: Settings, run_id: str) -> DataFrame:
    """Upserts of an approval pass: one row per granted request."""
    now = clock.as_of(settings.as_of_ms)
    at, planned_run = _planned(granted, settings)
    return _shaped(
        granted.select(
            F.col("resolved_role").alias("snowflake_role"),
            "snowflake_database",
            schema_key(F.col("snowflake_schema")).alias("snowflake_schema"),
            F.lit(GRANT).alias("op"),
            "urn",
            F.col("resolved_email").alias("requestor_email"),
            now.alias("granted_at"),
            clock.seconds_timestamp(F.col("expires_at_ms")).alias("expires_at"),
            F.lit(None).cast("timestamp").alias("revoked_at"),
            at.alias("at"),
            planned_run.alias("planned_run"),
            F.lit(APPROVAL_PHASE).alias("phase"),
            "seq",
            F.lit(settings.dry_run).alias("dry_run"),
            F.lit(run_id).alias("run_id"),
        )
    )


def revoke_rows(revoked: DataFrame, settings: Settings, run_id: str) -> DataFrame:
    """Revocations: the row being revoked, copied, with the time of revocation."""
    at, planned_run = _planned(revoked, settings)
    return _shaped(
        revoked.select(
            *KEY,
            F.lit(REVOKE).alias("op"),
            F.col("latest_action_request_urn").alias("urn"),
            "requestor_email",
            "granted_at",
            "expires_at",
            clock.as_of(settings.as_of_ms).alias("revoked_at"),
            at.alias("at"),
            planned_run.alias("planned_run"),
            F.lit(EXPIRY_PHASE).alias("phase"),
            F.lit(0).cast("bigint").alias("seq"),
            F.lit(settings.dry_run).alias("dry_run"),
            F.lit(run_id).alias("run_id"),
        )
    )


def journal_of(grants: DataFrame, run_id: str = "") -> DataFrame:
    """An existing grants table as journal rows, older than those of any run."""
    return _shaped(
        grants.select(
            *KEY,
            F.when(F.col("revoked_at").isNull(), F.lit(GRANT))
            .otherwise(F.lit(REVOKE))
            .alias("op"),
            F.col("latest_action_request_urn").alias("urn"),
            "requestor_email",
            "granted_at",
            "expires_at",
            "revoked_at",
            F.timestamp_millis(F.lit(0)).alias("at"),
            F.lit(APPROVAL_PHASE).alias("phase"),
            F.lit(0).cast("bigint").alias("seq"),
            F.lit(False).alias("dry_run"),
            F.lit(run_id).alias("run_id"),
        )
    )


def in_force(rows: DataFrame, include_dry: bool = False) -> DataFrame:
    """Rows that count: those of dry runs do not, unless asked for."""
    return rows if include_dry else rows.filter(~F.coalesce("dry_run", F.lit(False)))


def latest_rows(journal: DataFrame, also_by: Sequence[str] = ()) -> DataFrame:
    """Latest journal row per access key.

    An aggregate and not a window: copies of a hot key collapse before the shuffle.
    """
    keys = [*KEY, *also_by]
    rest = [name for name in schemas.JOURNAL.names if name not in keys]
    run = F.coalesce("planned_run", "run_id").alias("run")
    latest = journal.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("at", run, "phase", "seq")).alias("_row")
    )
    return latest.select(*keys, "_row.*").select(*schemas.JOURNAL.names)


def current_grants(journal: DataFrame) -> DataFrame:
    """The grants table, from the journal rows that count."""
    return latest_rows(journal).select(
        *KEY,
        F.col("urn").alias("latest_action_request_urn"),
        "requestor_email",
        "granted_at",
        "expires_at",
        "revoked_at",
    )


def calendar(folded: DataFrame) -> DataFrame:
    """Active grants with an end of a snapshot, which has one row per key and ``dry_run``.

    ``due_hour`` is the hour of the end. ``last`` tells whether the row is the latest of its key
    when dry runs count as well.
    """
    run = F.coalesce("planned_run", "run_id")
    newest_first = [F.desc("at"), run.desc(), F.desc("phase"), F.desc("seq")]
    # Two rows a key at most, so no partition of the window is large.
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy(*newest_first))
    hour = F.floor(F.unix_millis("expires_at") / HOUR_MS)
    return (
        folded.withColumn("last", place == 1)
        .where("revoked_at IS NULL AND expires_at IS NOT NULL")
        .withColumn("due_hour", hour)
    )


def expired_grants(grants: DataFrame, settings: Settings) -> DataFrame:
    """Active grants whose time is over; "all schemas" is null again."""
    return (
        grants.filter(
            (F.col("expires_at") <= clock.as_of_exact(settings.as_of_ms))
            & F.col("revoked_at").isNull()
        )
        .withColumn("snowflake_schema", non_empty(F.col("snowflake_schema")))
    )


def staying_grants(grants: DataFrame, settings: Settings) -> DataFrame:
    """Active grants whose time is not over."""
    over = F.col("expires_at") <= clock.as_of_exact(settings.as_of_ms)
    return grants.filter(F.col("revoked_at").isNull() & ~F.coalesce(over, F.lit(False)))


def sla_rows(notified: DataFrame, settings: Settings) -> DataFrame:
    """Records of SLA notifications."""
    return notified.select(
        F.col("urn").alias("action_request_urn"),
        F.col("sla_class").alias("notification_type"),
        clock.as_of(settings.as_of_ms).alias("sent_at"),
    )


def error_rows(failed: DataFrame, settings: Settings) -> DataFrame:
    """Records of permanent failures."""
    return failed.select(
        F.col("urn").alias("action_request_urn"),
        F.col("errno").cast("string").alias("snowflake_error_code"),
        F.col("message").alias("error_message"),
        clock.as_of(settings.as_of_ms).alias("failed_at"),
    )


def insert_absent(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append: those whose key the table does not have yet; the first entry stays."""
    return rows.join(table.select(*keys), keys, "left_anti").select(*rows.columns)
