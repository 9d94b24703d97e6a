"""Expiry by the calendar against the whole journal."""

import random
from dataclasses import replace
from datetime import datetime, timezone

import pytest

from grantline import schemas
from grantline.operators import outcomes
from grantline.plans import catchup, expiry
from grantline.state import journal as j
from grantline.state.store import StateStore
from tests.builders import DAY, HOUR, flat, flat_row, grants, no_errors, no_sla, properties, rows_of
from tests.conftest import AS_OF_MS

COLUMNS = [
    "snowflake_role", "snowflake_database", "snowflake_schema", "latest_action_request_urn",
    "expires_at",
]


def at(ms):
    return None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc)


def change(run, key, urn, hour, ends=None, op="grant", planned=None, dry=False, seq=0):
    """One journal row; hours are counted from the clock of the tests."""
    clock = AS_OF_MS + (hour if planned is None else planned[0]) * HOUR
    now = at(AS_OF_MS + hour * HOUR)
    return {
        "snowflake_role": key[0],
        "snowflake_database": key[1],
        "snowflake_schema": key[2],
        "op": op,
        "urn": urn,
        "requestor_email": "a@b.c",
        "granted_at": now,
        "expires_at": None if ends is None else at(AS_OF_MS + ends * HOUR),
        "revoked_at": now if op == "revoke" else None,
        "at": at(clock),
        "planned_run": planned and planned[1],
        "phase": int(op == "revoke"),
        "seq": seq,
        "dry_run": dry,
        "run_id": run,
    }


def write(store, run, rows):
    frame = store.spark.createDataFrame(rows, schemas.JOURNAL)
    return store.write("journal", frame, run, "step")


def expired(rows, settings):
    return rows_of(expiry.expired(j.current_grants(rows), settings), *COLUMNS)


def compare(store, settings, run=None):
    """Both ways at a clock amid the ends, with dry runs and without."""
    found = []
    for dry in (False, True):
        config = replace(settings, as_of_ms=AS_OF_MS + 7 * HOUR, count_dry_runs=dry)
        wanted = expired(store.state(run, dry).journal, config)
        assert expired(store.due_rows(config, run), config) == wanted
        found += wanted
    return found


@pytest.mark.parametrize("seed", range(2))
def test_random_histories(spark, settings, tmp_path, seed):
    source = random.Random(seed)
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    keys = [(r, "D", s) for r in ("A", "B", None) for s in ("", "S")]
    found = []
    for n in range(5):
        if n in (2, 4):
            store.compact()
        run = f"r{n}"
        rows = []
        for k in source.sample(keys, 4):
            # Some changes were planned by a run before, and so before the snapshot.
            before = source.randrange(n) if n and source.random() < 0.4 else None
            planned = None if before is None else (before, f"r{before}")
            ends = source.choice([None, -24, -1, 0, 6, 7, 8, 30])
            op = "revoke" if source.random() < 0.25 else "grant"
            dry = source.random() < 0.25
            rows.append(change(run, k, f"{run}:{k}", n, ends, op, planned, dry, seq=n))
        write(store, run, rows)
        if n > 1:
            found += compare(store, settings)
    found += compare(store, settings, "r4")
    assert found


def test_a_change_planned_before_a_later_one_in_the_snapshot(spark, settings, tmp_path):
    """The extension in the snapshot stays, though its hour is not opened."""
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    write(store, "r2", [change("r2", ("A", "D", ""), "long", 2, 1000)])
    store.compact()
    write(store, "r3", [change("r3", ("A", "D", ""), "short", 3, 4, planned=(1, "r1"))])
    later = replace(settings, as_of_ms=AS_OF_MS + 5 * HOUR)
    assert expired(store.due_rows(later, None), later) == []


def test_only_hours_that_are_over_are_opened(spark, settings, tmp_path):
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    write(store, "r", [change("r", (f"R{n}", "D", ""), f"u{n}", 0, n - 3) for n in range(40)])
    store.compact()
    rows = store.due_rows(settings, None)
    opened = [f for f in rows.inputFiles() if "/calendar/" in f]
    assert opened and not [f for f in rows.inputFiles() if "snapshot_rows" in f]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(due_hour" in plan
    # Ends at whole hours from the clock on: three before it and the one at it.
    assert rows.count() == 4 == len(expired(rows, settings))


def test_nothing_folded_and_nothing_in_the_snapshot(spark, settings, tmp_path):
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    assert store.due_rows(settings, None).count() == 0
    store.compact()
    assert store.due_rows(settings, None).count() == 0
    write(store, "r", [change("r", ("A", "D", ""), "u", -5, -1)])
    assert len(expired(store.due_rows(settings, None), settings)) == 1


def test_a_failed_revoke_is_tried_again_after_folds(spark, settings, tmp_path):
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    held = ("ANALYST_ROLE", "PROD", "SALES", "held", None, AS_OF_MS - DAY, AS_OF_MS - HOUR, None)
    store.import_state(grants(spark, held), no_sla(spark), no_errors(spark))
    asked = flat(spark, flat_row("short", 1, snowflake_schema="S2", duration_raw="1"))
    users = properties(spark, ("bob", "DEFAULT_ROLE", "BOBS_ROLE"))

    def run(run_id, hours, execute):
        store.compact()
        store.drop_folded()
        config = replace(settings, as_of_ms=AS_OF_MS + hours * HOUR)
        state = catchup.run(store, asked, users, config, run_id, execute)
        active = state.grants.where("revoked_at IS NULL")
        return [r[0] for r in rows_of(active, "latest_action_request_urn")]

    def refused(rows):
        ok = rows["urn"] != "held"
        done = outcomes.all_ok(rows)
        return done.withColumn("ok", ok)

    assert run("r1", 0, refused) == ["held", "short"]
    assert run("r2", 2, outcomes.all_ok) == ["short"]
    assert run("r3", 25, outcomes.all_ok) == []
