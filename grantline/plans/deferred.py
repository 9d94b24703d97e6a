"""Full pass for systems that report outcomes later: settle what has arrived, then plan anew.

A run takes the outcomes that came in since the last one, closes the units they decide, and
hands what is still open, with its new units, to the next run. A statement goes out once
while its unit is open: its request waits, and so does every change of an access key that
would overtake it. The order of grants is that of their plans, whenever they are settled.
Outcomes of no open unit are quarantined. A run may be repeated under its id.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.operators import ledger, metrics
from grantline.plans import approval, catchup, expiry
from grantline.settings import Settings
from grantline.state import journal as j
from grantline.state.store import State, StateStore


def settle_arrived(
    store: StateStore,
    state: State,
    arrived: DataFrame,
    settings: Settings,
    run_id: str,
    wait_hours: int | None = None,
) -> tuple[DataFrame, State, list[DataFrame]]:
    """Record what the outcomes decide; what stays open, the state after it, and the journal rows
    it added."""
    open_ = store.open_units.read(run_id)
    judged = store.write(
        "judged", ledger.progress(open_, arrived, settings, wait_hours), run_id, "ledger"
    )
    strange = ledger.not_open(open_, arrived)
    stored = store.earlier("quarantine", run_id, settings.count_dry_runs)
    fresh = strange.join(stored.where(F.col("reason") == ledger.NOT_OPEN), "urn", "left_anti")
    store.write("quarantine", fresh, run_id, "ledger")
    done = ledger.closed_requests(judged, state.provisioning_errors, settings)
    ended = ledger.closed_grants(judged)
    granted = catchup.record_approvals(store, done, settings, run_id, "ledger")
    revoked = catchup.record_revokes(store, ended, settings, run_id, "ledger-revoke")
    after = replace(
        state,
        journal=state.journal.unionByName(granted).unionByName(revoked),
        granted_urns=state.granted_urns.unionByName(granted.select("urn")),
        provisioning_errors=state.provisioning_errors.unionByName(
            approval.settle(done, settings, run_id).errors
        ),
    )
    return judged.where(F.col("outcome").isNull()).drop("outcome"), after, [granted, revoked]


def run(
    store: StateStore,
    flat: DataFrame,
    user_properties: DataFrame,
    settings: Settings,
    run_id: str,
    arrived: DataFrame,
    wait_hours: int | None = None,
) -> State:
    """One scheduled run; ``arrived`` are outcome rows, in part or repeated as they may be.

    The planned statements are in the outbox. Returns the state after the run. A dry run is
    one of :func:`grantline.plans.catchup.run`: it has no outcomes to wait for.
    """
    if settings.dry_run:
        raise ValueError("a dry run sends nothing out; use plans.catchup.run")
    store.ensure().fold(run_id)
    before = store.state(run_id, settings.count_dry_runs)
    open_, state, added = settle_arrived(store, before, arrived, settings, run_id, wait_hours)
    decided = store.write(
        "decisions",
        ledger.hold_requests(approval.decide(flat, state, user_properties, settings), open_),
        run_id,
        "approval",
    )
    catchup.quarantine_decided(store, decided, settings, run_id)
    store.write("metrics", metrics.decision_counts(decided, settings), run_id, "approval")
    store.write("statements", approval.plan(decided, settings), run_id, "approval")
    asked = ledger.grant_units(approval.to_provision(decided), settings, run_id)
    busy = open_.unionByName(asked)
    ends = catchup.may_end(store, before, settings, run_id, *added)
    expired = expiry.expired(j.current_grants(ends), settings)
    due = store.write("expired", ledger.hold_grants(expired, busy), run_id, "expiry")
    store.write("statements", expiry.plan(due, settings), run_id, "expiry")
    store.open_units.write(
        busy.unionByName(ledger.revoke_units(due, settings, run_id)), run_id
    )
    catchup.sla_notices(store, state, flat, settings, run_id)
    return store.state(None, settings.count_dry_runs)
