"""Statements whose outcomes arrive after their run: what is open, and what closes it.

A unit is one request to grant or one grant to revoke, with all its statements. It stays open
until a statement is known to have failed, all are known to have succeeded, or its time to wait
is over. Each statement counts once: the earliest outcome wins, a failure before a success of
the same time, and what an earlier run took in stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline import schemas
from grantline.functions import clock
from grantline.functions.identity import non_empty
from grantline.operators import decisions, outcomes, statements
from grantline.operators.sequence import KEY, schema_key
from grantline.operators.skew import by_shuffle
from grantline.settings import Settings

UNIT = ["planned_run", "action", "urn", *KEY]
GRANT, REVOKE = "grant", "revoke"
#: Decision on a request whose statements, or a revoke of whose access key, are still out.
WAIT = "wait_for_outcomes"
NOT_OPEN = "outcome_not_open"


def _units(rows: DataFrame, settings: Settings, run_id: str, action: str, size: Column) -> DataFrame:
    return rows.withColumns(
        {
            "planned_run": F.lit(run_id),
            "action": F.lit(action),
            "statements": size.cast("int"),
            "planned_at": clock.as_of_exact(settings.as_of_ms),
            "ok_bits": F.lit(0).cast("long"),
        }
    ).to(schemas.OPEN_UNITS)


def grant_units(provisioned: DataFrame, settings: Settings, run_id: str) -> DataFrame:
    """Open units of requests whose statements go out."""
    rows = provisioned.select(
        "urn",
        "seq",
        "note",
        "resource",
        F.col("snowflake_role").alias("form_role"),
        F.col("snowflake_schema").alias("form_schema"),
        F.col("requestor_email").alias("form_email"),
        "resolved_email",
        F.col("access_duration_days").cast("int").alias("access_duration_days"),
        "failed",
        F.size(statements.grant_plan(settings)).alias("size_"),
        F.col("resolved_role"),
        "snowflake_database",
        schema_key(non_empty(F.col("snowflake_schema"))).alias("snowflake_schema"),
    ).withColumnRenamed("resolved_role", "snowflake_role")
    return _units(rows, settings, run_id, GRANT, F.col("size_"))


def revoke_units(due: DataFrame, settings: Settings, run_id: str) -> DataFrame:
    """Open units of grants whose revokes go out."""
    sized = due.withColumn("size_", F.size(statements.revoke_plan(settings)))
    rows = sized.select(
        F.col("latest_action_request_urn").alias("urn"),
        "snowflake_role",
        "snowflake_database",
        schema_key(F.col("snowflake_schema")).alias("snowflake_schema"),
        F.col("requestor_email").alias("form_email"),
        "granted_at",
        "expires_at",
        "size_",
    )
    return _units(rows, settings, run_id, REVOKE, F.col("size_"))


def first_outcomes(arrived: DataFrame) -> DataFrame:
    """One outcome per statement. An aggregate, so that copies collapse before the shuffle."""
    known = arrived.where(F.col("ok").isNotNull() & F.col("stmt_no").isNotNull()).withColumn(
        "snowflake_schema", schema_key(F.col("snowflake_schema"))
    )
    order = F.struct(F.col("at").isNull(), "at", "ok", "errno", "message")
    return known.groupBy(*UNIT, "stmt_no").agg(
        F.min_by(F.struct("ok", "errno", "message"), order).alias("first")
    )


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (number - 1).cast("int"))


def progress(
    units: DataFrame, arrived: DataFrame, settings: Settings, wait_hours: int | None = None
) -> DataFrame:
    """Open units with what has arrived, and ``outcome``: null while a unit stays open.

    ``wait_hours`` ends the wait: such a unit counts as cut short and is tried again.
    """
    known = units.select(*UNIT, "statements", "ok_bits")
    fresh = (
        first_outcomes(arrived)
        .join(by_shuffle(known), UNIT)
        .where(F.col("stmt_no").between(1, F.col("statements")))
        .where(F.col("ok_bits").bitwiseAND(_bit(F.col("stmt_no"))) == 0)
    )
    failed = F.when(~F.col("first.ok"), F.col("stmt_no"))
    news = fresh.groupBy(*UNIT).agg(
        F.bit_or(F.when(F.col("first.ok"), _bit(F.col("stmt_no")))).alias("new_bits"),
        F.min(failed).alias("new_failed"),
        F.min_by("first", failed).alias("new_first"),
    )
    told = units.join(by_shuffle(news), UNIT, "left").withColumns(
        {
            "ok_bits": F.col("ok_bits").bitwiseOR(F.coalesce("new_bits", F.lit(0).cast("long"))),
            "failed_stmt": F.col("new_failed"),
            "errno": F.when(F.col("new_failed").isNotNull(), F.col("new_first.errno")),
            "message": F.when(F.col("new_failed").isNotNull(), F.col("new_first.message")),
        }
    )
    over = F.lit(False)
    if wait_hours is not None:
        waited = F.lit(settings.as_of_ms) - F.unix_millis("planned_at")
        over = waited >= wait_hours * 3_600_000
    broken = F.col("failed_stmt").isNotNull()
    outcome = (
        F.when(broken & outcomes.is_permanent(F.col("errno")), F.lit(outcomes.PERMANENT))
        .when(broken, F.lit(outcomes.TRANSIENT))
        .when(F.bit_count("ok_bits") == F.col("statements"), F.lit(outcomes.GRANTED))
        .when(over, F.lit(outcomes.TRANSIENT))
    )
    return told.select(*schemas.OPEN_UNITS.names, outcome.alias("outcome"))


def not_open(units: DataFrame, arrived: DataFrame) -> DataFrame:
    """Quarantine rows of outcomes that belong to no open unit: late, or of no statement."""
    open_ = by_shuffle(units.select(*UNIT))
    strange = first_outcomes(arrived).join(open_, UNIT, "left_anti")
    return strange.groupBy("urn").agg(
        F.lit(NOT_OPEN).alias("reason"),
        F.concat_ws(" ", F.min("planned_run"), F.min("action"), F.min("stmt_no")).alias("detail"),
    )


def closed_requests(judged: DataFrame, errors: DataFrame, settings: Settings) -> DataFrame:
    """Closed grant units as requests with an outcome; the time limit starts now."""
    rows = judged.where((F.col("action") == GRANT) & F.col("outcome").isNotNull())
    recorded = errors.select(F.col("action_request_urn").alias("urn"), F.lit(True).alias("on_record"))
    named = rows.select(
        *[n for n in rows.columns if n not in ("snowflake_role", "snowflake_schema", "expires_at")],
        F.col("snowflake_role").alias("resolved_role"),
        F.col("form_role").alias("snowflake_role"),
        F.col("form_schema").alias("snowflake_schema"),
        F.col("form_email").alias("requestor_email"),
        clock.expiry_ms(settings.as_of_ms, F.col("access_duration_days")).alias("expires_at_ms"),
    )
    return (
        named.join(by_shuffle(recorded.distinct()), "urn", "left")
        .withColumn("failed", F.coalesce("failed", F.lit(False)) | F.coalesce("on_record", F.lit(False)))
        .drop("on_record")
    )


def closed_grants(judged: DataFrame) -> DataFrame:
    """Closed revoke units as grants with an outcome."""
    rows = judged.where((F.col("action") == REVOKE) & F.col("outcome").isNotNull())
    return rows.withColumns(
        {"latest_action_request_urn": F.col("urn"), "requestor_email": F.col("form_email")}
    )


def hold_requests(decided: DataFrame, units: DataFrame) -> DataFrame:
    """Requests that wait: their own statements are out, or a revoke of their access key."""
    own = units.where(F.col("action") == GRANT).select("urn").distinct().withColumn("own_", F.lit(True))
    keys = units.where(F.col("action") == REVOKE).select(
        F.col("snowflake_role").alias("resolved_role"),
        "snowflake_database",
        F.col("snowflake_schema").alias("schema_"),
        F.lit(True).alias("key_"),
    )
    marked = decided.withColumn("schema_", schema_key(non_empty(F.col("snowflake_schema"))))
    marked = marked.join(by_shuffle(own), "urn", "left").join(
        by_shuffle(keys.distinct()), ["resolved_role", "snowflake_database", "schema_"], "left"
    )
    waits = F.coalesce("own_", "key_", F.lit(False)) & (F.col("decision") == decisions.PROVISION)
    return marked.withColumn(
        "decision", F.when(waits, F.lit(WAIT)).otherwise(F.col("decision"))
    ).select(decided.columns)


def hold_grants(due: DataFrame, units: DataFrame) -> DataFrame:
    """Grants to revoke but for those whose access key has statements out."""
    busy = units.select(*KEY[:2], F.col(KEY[2]).alias("schema_")).distinct()
    marked = due.withColumn("schema_", schema_key(F.col("snowflake_schema")))
    return marked.join(by_shuffle(busy), [*KEY[:2], "schema_"], "left_anti").select(due.columns)
