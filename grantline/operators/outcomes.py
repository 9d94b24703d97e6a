"""Outcomes of executed statements, rolled up to their request or grant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.operators.skew import by_shuffle
from grantline.settings import PERMANENT_ERRNOS

GRANTED = "granted"
PERMANENT = "permanent"
TRANSIENT = "transient"


def is_permanent(errno: Column) -> Column:
    """Only a missing object can not be cured by trying again."""
    return F.coalesce(errno.isin(*PERMANENT_ERRNOS), F.lit(False))


def all_ok(statements: DataFrame) -> DataFrame:
    """Outcomes of a run in which every statement succeeds (dry runs, tests)."""
    return statements.withColumns(
        {
            "ok": F.lit(True),
            "errno": F.lit(None).cast("int"),
            "message": F.lit(None).cast("string"),
        }
    )


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def roll_up(outcomes: DataFrame, by: Sequence[str] = ("urn",)) -> DataFrame:
    """One row per ``by``: the first failing statement decides.

    ``partial`` marks groups whose earlier statements stay in force although a later
    one failed. ``succeeded`` counts distinct successful statements.
    """
    failed = ~F.col("ok")
    rolled = outcomes.groupBy(*by).agg(
        F.bool_and("ok").alias("_all_ok"),
        F.min(F.when(failed, F.col("stmt_no"))).alias("failed_stmt"),
        F.min_by(
            F.struct("errno", "message"), F.when(failed, F.col("stmt_no"))
        ).alias("_error"),
        # Statement numbers are small: a bit each counts them without another shuffle.
        F.bit_count(
            F.coalesce(F.bit_or(F.when(F.col("ok"), _bit(F.col("stmt_no")))), F.lit(0).cast("long"))
        ).alias("succeeded"),
    )
    errno = F.when(~F.col("_all_ok"), F.col("_error.errno"))
    return rolled.select(
        *by,
        F.when(F.col("_all_ok"), F.lit(GRANTED))
        .when(is_permanent(errno), F.lit(PERMANENT))
        .otherwise(F.lit(TRANSIENT))
        .alias("outcome"),
        F.coalesce(F.col("failed_stmt") > 1, F.lit(False)).alias("partial"),
        "failed_stmt",
        errno.alias("errno"),
        F.when(~F.col("_all_ok"), F.col("_error.message")).alias("message"),
        F.col("succeeded").cast("int").alias("succeeded"),
    )


def with_outcomes(
    planned: DataFrame, outcomes: DataFrame, expected: Column, by: Sequence[str] = ("urn",)
) -> DataFrame:
    """Joins the roll-up to what was planned.

    A row with no outcome, or with fewer successes than statements, was cut short
    and is tried again. A row that needs no statement is done.
    """
    cut_short = F.col("outcome").isNull() | (
        (F.col("outcome") == GRANTED) & (F.col("succeeded") < expected)
    )
    return planned.join(by_shuffle(roll_up(outcomes, by)), list(by), "left").withColumn(
        "outcome",
        F.when(expected == 0, F.lit(GRANTED))
        .when(cut_short, F.lit(TRANSIENT))
        .otherwise(F.col("outcome")),
    )
