"""Full catch-up: approvals, expiry, SLA, in that order, written to the store.

Each step is written once and read back, so no plan is computed twice and the number
of Spark jobs does not depend on the number of requests. A run may be repeated under
its id after an interruption at any point.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import metrics, outcomes, quarantine
from grantline.plans import approval, expiry, sla
from grantline.settings import Settings
from grantline.state import journal as j
from grantline.state.store import State, StateStore

Execute = Callable[[DataFrame], DataFrame]


def approvals(
    store: StateStore,
    state: State,
    flat: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
    run_id: str,
    execute: Execute,
) -> DataFrame:
    """Approval step; returns the journal rows it wrote."""
    decided = store.write(
        "decisions", approval.decide(flat, state, user_properties, settings), run_id, "approval"
    )
    return settle_approvals(store, decided, settings, run_id, execute)


def settle_approvals(
    store: StateStore,
    decided: DataFrame,
    settings: Settings,
    run_id: str,
    execute: Execute,
    live: bool = False,
) -> DataFrame:
    """Metrics, statements, journal, errors and mails of written decisions."""
    quarantine_decided(store, decided, settings, run_id, live)
    store.write("metrics", metrics.decision_counts(decided, settings), run_id, "approval")
    planned = store.write("statements", approval.plan(decided, settings), run_id, "approval")
    done = store.write(
        "results",
        approval.results(decided, executed(planned, settings, execute), settings),
        run_id,
        "approval",
    )
    return record_approvals(store, done, settings, run_id, "approval")


def record_approvals(
    store: StateStore, done: DataFrame, settings: Settings, run_id: str, step: str
) -> DataFrame:
    """Journal, errors and mails of requests with their outcome; returns the journal rows."""
    settled = approval.settle(done, settings, run_id)
    dry = settings.dry_run
    written = store.write("journal", settled.journal, run_id, step)
    store.write("provisioning_errors", settled.errors, run_id, step, dry)
    store.write("notifications", settled.notifications, run_id, step, dry)
    return with_run(written, run_id)


def quarantine_decided(
    store: StateStore, decided: DataFrame, settings: Settings, run_id: str, live: bool = False
) -> None:
    """Store what needs a look once, however many runs meet it."""
    found = quarantine.quarantined(decided)
    include_dry = settings.count_dry_runs or settings.dry_run
    if live:
        stored = store.matching("quarantine", decided, "urn", run_id, include_dry)
    else:
        stored = store.earlier("quarantine", run_id, include_dry)
    fresh = quarantine.not_stored(found, stored)
    store.write("quarantine", fresh, run_id, "approval", settings.dry_run)


def executed(planned: DataFrame, settings: Settings, execute: Execute) -> DataFrame:
    """Outcomes of the statements; a dry run executes none and takes all for done."""
    return outcomes.all_ok(planned) if settings.dry_run else execute(planned)


def with_run(rows: DataFrame, run_id: str) -> DataFrame:
    return rows.withColumn("run_id", F.lit(run_id))


def may_end(
    store: StateStore, state: State, settings: Settings, run_id: str, *fresh: DataFrame
) -> DataFrame:
    """Journal rows that an expiry step needs, with those that this run has added.

    The calendar's, unless what stays in force has a say in what is revoked.
    """
    if settings.keep_shared_privileges:
        return reduce(DataFrame.unionByName, fresh, state.journal)
    return store.due_rows(settings, run_id, *fresh)


def expiries(
    store: StateStore,
    journal: DataFrame,
    settings: Settings,
    run_id: str,
    execute: Execute,
) -> DataFrame:
    """Expiry step on journal rows that hold this run's approvals already."""
    due = store.write(
        "expired", expiry.expired(j.current_grants(journal), settings), run_id, "expiry"
    )
    planned = store.write("statements", expiry.plan(due, settings), run_id, "expiry")
    outcome_rows = executed(planned, settings, execute)
    done = store.write("results", expiry.results(due, outcome_rows, settings), run_id, "expiry")
    return record_revokes(store, done, settings, run_id, "expiry")


def record_revokes(
    store: StateStore, done: DataFrame, settings: Settings, run_id: str, step: str
) -> DataFrame:
    """Journal and mails of grants to revoke with their outcome; returns the journal rows."""
    revoked = expiry.settle(done, settings, run_id)
    written = store.write("journal", revoked.journal, run_id, step)
    store.write("notifications", revoked.notifications, run_id, step, settings.dry_run)
    return with_run(written, run_id)


def sla_notices(
    store: StateStore, state: State, flat: DataFrame, settings: Settings, run_id: str
) -> DataFrame:
    """SLA step; returns the breaches it notified."""
    breaches = store.write(
        "breaches", sla.due(flat, state.sla_notifications, settings), run_id, "sla"
    )
    notified = sla.settle(breaches, settings)
    store.write("sla_notifications", notified.records, run_id, "sla", settings.dry_run)
    store.write("notifications", notified.notifications, run_id, "sla", settings.dry_run)
    return breaches


def run(
    store: StateStore,
    flat: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
    run_id: str,
    execute: Execute,
) -> State:
    """One scheduled run. ``execute`` turns statement rows into outcome rows.

    Returns the state after the run. In a dry run nothing is executed and the rows
    written are marked, so that a later live run does not count them.
    """
    store.ensure().fold(run_id)
    state = store.state(run_id, settings.count_dry_runs)
    granted = approvals(store, state, flat, user_properties, settings, run_id, execute)
    expiries(store, may_end(store, state, settings, run_id, granted), settings, run_id, execute)
    sla_notices(store, state, flat, settings, run_id)
    return store.state(None, settings.count_dry_runs)
