"""Approval pass: decide, plan statements, settle their outcomes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import decisions, notices, outcomes, statements
from grantline.settings import Settings
from grantline.state import journal as j
from grantline.state.store import State


@dataclass(frozen=True)
class Settled:
    """What an approval pass writes once the outcomes are known."""

    journal: DataFrame
    errors: DataFrame
    notifications: DataFrame


def decide(
    flat: DataFrame, state: State, user_properties: DataFrame, settings: Settings
) -> DataFrame:
    return decisions.catchup_decisions(
        flat,
        state.grants,
        state.granted_urns,
        state.provisioning_errors,
        user_properties,
        settings,
    )


def to_provision(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("decision") == decisions.PROVISION)


def plan(decided: DataFrame, settings: Settings) -> DataFrame:
    """Statement rows to execute."""
    return statements.grant_rows(to_provision(decided), settings)


def results(decided: DataFrame, outcome_rows: DataFrame, settings: Settings) -> DataFrame:
    """Provisioned requests with their outcome."""
    return outcomes.with_outcomes(
        to_provision(decided), outcome_rows, F.size(statements.grant_plan(settings))
    )


def settle(done: DataFrame, settings: Settings, run_id: str) -> Settled:
    """State rows and mails that follow from the outcomes.

    Granted requests are recorded and mailed. A permanent failure is recorded and
    mailed unless one is on record. A transient failure leaves no trace: the
    request comes up again in the next pass.
    """
    granted = done.filter(F.col("outcome") == outcomes.GRANTED)
    # ``failed`` tells whether an error was on record before this pass.
    fresh = done.filter((F.col("outcome") == outcomes.PERMANENT) & ~F.col("failed"))
    return Settled(
        journal=j.grant_rows(granted, settings, run_id),
        errors=j.error_rows(fresh, settings),
        notifications=notices.approval(granted, settings).unionByName(
            notices.failure(fresh, settings)
        ),
    )
