"""Outcomes that arrive later: what closes a unit, and runs that wait for it."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantline import schemas
from grantline.operators import ledger
from grantline.plans import catchup, deferred
from grantline.sources.outcomes import read_outcomes
from grantline.state.store import StateStore
from tests.builders import DAY, HOUR, flat, flat_row, grants, no_errors, no_sla, properties, rows_of
from tests.conftest import AS_OF_MS

OUTCOME = "stmt_no int, ok boolean, errno int, message string, minute long"


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state")).ensure()


def unit(spark, urn="u", statements=3, action="grant", planned_ms=AS_OF_MS):
    row = spark.createDataFrame([("r1", action, urn, "R", "D", "S", statements)],
        "planned_run string, action string, urn string, snowflake_role string, "
        "snowflake_database string, snowflake_schema string, statements int")  # fmt: skip
    return row.withColumn("planned_at", F.timestamp_millis(F.lit(planned_ms))).withColumn(
        "ok_bits", F.lit(0).cast("long")
    ).to(schemas.OPEN_UNITS)


def arrived(spark, *rows, urn="u", run="r1", action="grant"):
    frame = spark.createDataFrame(list(rows), OUTCOME)
    return frame.select(
        F.lit(run).alias("planned_run"),
        F.lit(action).alias("action"),
        F.lit(urn).alias("urn"),
        F.lit("R").alias("snowflake_role"),
        F.lit("D").alias("snowflake_database"),
        F.lit("S").alias("snowflake_schema"),
        "*",
        F.lit(None).cast("string").alias("statement"),
        F.timestamp_seconds(F.col("minute") * 60).alias("at"),
    ).select(*schemas.STATEMENT_OUTCOMES.names)


def good(*numbers, minute=1):
    return [(n, True, None, None, minute) for n in numbers]


def judged(spark, settings, rows, **options):
    found = ledger.progress(unit(spark), arrived(spark, *rows), settings, **options)
    (row,) = found.collect()
    return row.outcome, bin(row.ok_bits), row.failed_stmt


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        (good(1, 2, 3), ("granted", "0b111", None)),
        (good(3, 1), (None, "0b101", None)),
        (good(1, 1, 1, 2), (None, "0b11", None)),
        # Of no statement of the unit, or without a result.
        (good(0, 4, 99), (None, "0b0", None)),
        ([(1, None, None, None, 1), *good(2)], (None, "0b10", None)),
        ([*good(1), (2, False, 2003, "gone", 2)], ("permanent", "0b1", 2)),
        ([(3, False, 604, "x", 2), (2, False, 2001, "y", 3)], ("permanent", "0b0", 2)),
        # The earliest outcome of a statement counts; a failure before a success of its time.
        ([*good(1, 2, 3), (2, False, 604, "late", 9)], ("granted", "0b111", None)),
        ([*good(1, 2, 3), (2, False, 604, "same", 1)], ("transient", "0b101", 2)),
    ],
)
def test_progress_of_a_unit(spark, settings, rows, expected):
    assert judged(spark, settings, rows) == expected


def test_what_an_earlier_run_took_in_stays(spark, settings):
    once = ledger.progress(unit(spark), arrived(spark, *good(1, 2)), settings).drop("outcome")
    again = arrived(spark, (1, False, 2003, "no", 0), *good(3))
    (row,) = ledger.progress(once, again, settings).collect()
    assert (row.outcome, row.failed_stmt) == ("granted", None)


def test_the_wait_may_end(spark, settings):
    late = replace(settings, as_of_ms=AS_OF_MS + 5 * HOUR)
    for hours, outcome in ((None, None), (6, None), (5, "transient")):
        assert judged(spark, late, good(1), wait_hours=hours)[0] == outcome


def outcomes_of(store, run_id, keep="true", **changed):
    """Outcomes of a run's statements, all good unless ``changed`` says otherwise."""
    rows = store.read("statements").where(F.col("run_id") == run_id).where(keep)
    ok = F.expr(changed.get("ok", "true"))
    return rows.withColumn("planned_run", F.lit(run_id)).withColumns(
        {
            "ok": ok,
            "errno": F.when(~ok, F.lit(changed.get("errno", 604))).cast("int"),
            "message": F.when(~ok, F.lit("it failed")),
            "at": F.timestamp_millis(F.lit(AS_OF_MS)),
        }
    ).select(*schemas.STATEMENT_OUTCOMES.names)


def none(spark):
    return spark.createDataFrame([], schemas.STATEMENT_OUTCOMES)


def step(store, requests, settings, run_id, rows, hours=0, **options):
    now = replace(settings, as_of_ms=settings.as_of_ms + hours * HOUR)
    props = properties(store.spark, ("bob", "DEFAULT_ROLE", "BOBS_ROLE"))
    return deferred.run(store, requests, props, now, run_id, rows, **options)


def decisions(store, run_id):
    frame = store.spark.read.parquet(f"{store.path('decisions')}/run_id={run_id}/step=approval")
    return rows_of(frame, "urn", "decision")


def mails(store, run_id):
    return rows_of(store.read("notifications").where(F.col("run_id") == run_id), "type", "urn")


def test_runs_that_wait(spark, settings, store):
    requests = flat(
        spark,
        flat_row("good", 1, snowflake_role="A", duration_raw="1"),
        flat_row("slow", 2, snowflake_role="B"),
        flat_row("gone", 3, snowflake_role="C"),
        flat_row("flaky", 4, snowflake_role="D"),
    )
    state = step(store, requests, settings, "r1", none(spark))
    assert state.grants.count() == 0 and mails(store, "r1") == []
    assert store.read("statements").count() == 16 and store.open_units.read().count() == 4

    first = (
        outcomes_of(store, "r1", "urn = 'good' or (urn = 'slow' and stmt_no < 3)")
        .unionByName(outcomes_of(store, "r1", "urn = 'gone' and stmt_no = 1", ok="false", errno=2003))
        .unionByName(outcomes_of(store, "r1", "urn = 'flaky' and stmt_no < 3", ok="stmt_no < 2"))
    )
    # Repeated as delivered twice, and as an attempt that failed and is run again.
    for _ in range(2):
        state = step(store, requests, settings, "r2", first.unionByName(first), 2)
    assert [r[0] for r in rows_of(state.grants, "latest_action_request_urn")] == ["good"]
    assert decisions(store, "r2") == [
        ("flaky", "provision"), ("gone", "skip_failed"),
        ("good", "skip_provisioned"), ("slow", "wait_for_outcomes"),
    ]
    assert mails(store, "r2") == [("approval", "good"), ("failure", "gone")]
    assert rows_of(store.open_units.read(), "planned_run", "urn") == [("r1", "slow"), ("r2", "flaky")]

    late = first.unionByName(outcomes_of(store, "r1", "urn = 'slow'", ok="stmt_no > 1"))
    state = step(store, requests, settings, "r3", late.unionByName(outcomes_of(store, "r2", "urn = 'flaky'")), 3)
    # What was known of statement 1 of "slow" stays, whatever is said later.
    assert [r[0] for r in rows_of(state.grants, "latest_action_request_urn")] == ["flaky", "good", "slow"]
    strange = store.read("quarantine").where("reason = 'outcome_not_open'")
    assert rows_of(strange, "urn", "run_id") == [("flaky", "r3"), ("gone", "r3"), ("good", "r3")]
    assert store.open_units.read().count() == 0
    # One approval each over all runs, and one plan per unit.
    sent = store.read("notifications").where("type = 'approval'").groupBy("urn").count()
    assert {r["count"] for r in sent.collect()} == {1}


def test_the_time_limit_starts_when_the_grant_is_known(spark, settings, store):
    requests = flat(spark, flat_row("a", 1, duration_raw="2"))
    step(store, requests, settings, "r1", none(spark))
    state = step(store, requests, settings, "r2", outcomes_of(store, "r1"), 30)
    row = state.grants.select(F.unix_millis("granted_at"), F.unix_millis("expires_at")).first()
    assert tuple(row) == (AS_OF_MS + 30 * HOUR, AS_OF_MS + 30 * HOUR + 2 * DAY)


def test_plans_decide_the_order_of_one_key(spark, settings, store):
    """The later request of a key ends up in its row, also if it is settled first."""
    requests = flat(spark, flat_row("a", 1), flat_row("b", 2))
    step(store, requests, settings, "r1", none(spark))
    state = step(store, requests, settings, "r2", outcomes_of(store, "r1", "urn = 'b'"), 1)
    assert rows_of(state.grants, "latest_action_request_urn") == [("b",)]
    state = step(store, requests, settings, "r3", outcomes_of(store, "r1", "urn = 'a'"), 2)
    assert rows_of(state.grants, "latest_action_request_urn") == [("b",)]
    assert rows_of(state.granted_urns, "urn") == [("a",), ("b",)]
    store.compact()
    assert rows_of(store.state().grants, "latest_action_request_urn") == [("b",)]


def test_revokes_wait_too(spark, settings, store):
    old = AS_OF_MS - DAY
    store.import_state(
        grants(
            spark,
            ("A", "PROD", "SALES", "x", "x@y.z", 0, old, None),
            ("B", "PROD", "", "y", None, 0, old, None),
            ("C", "PROD", "SALES", "z", None, 0, old, None),
        ),
        no_sla(spark),
        no_errors(spark),
    )
    # An extension of C is asked for: its revoke waits for the grant.
    requests = flat(spark, flat_row("ext", 1, snowflake_role="C"))
    step(store, requests, settings, "r1", none(spark))
    planned = store.read("statements").where("action = 'revoke'")
    assert rows_of(planned.select("urn").distinct(), "urn") == [("x",), ("y",)]
    rows = outcomes_of(store, "r1", "urn in ('x', 'ext')").unionByName(
        outcomes_of(store, "r1", "urn = 'y'", ok="false", errno=2003)
    )
    state = step(store, requests, settings, "r2", rows, 1)
    revoked = state.grants.where("revoked_at is not null")
    assert rows_of(revoked, "latest_action_request_urn") == [("x",)]
    assert mails(store, "r2") == [("approval", "ext"), ("revocation", "x")]
    # A failed revoke is tried again and is no permanent error; x, asked for anew, waits for none.
    assert rows_of(store.open_units.read(), "planned_run", "action", "urn") == [("r2", "revoke", "y")]
    assert state.provisioning_errors.count() == 0
    again = requests.unionByName(flat(spark, flat_row("new", 2, snowflake_role="B", snowflake_schema="")))
    step(store, again, settings, "r3", none(spark), 2)
    assert ("new", "wait_for_outcomes") in decisions(store, "r3")


def test_a_dry_run_is_refused(spark, settings, store):
    with pytest.raises(ValueError, match="dry"):
        step(store, flat(spark), replace(settings, dry_run=True), "r1", none(spark))


def test_typed_outcomes_are_read(spark, tmp_path):
    arrived(spark, *good(1, 2)).write.parquet(str(tmp_path / "o"))
    found = read_outcomes(spark, str(tmp_path / "o"))
    assert found.schema.names == schemas.STATEMENT_OUTCOMES.names and found.count() == 2


def test_a_live_run_after_a_dry_one_does_all_of_it(spark, settings, tmp_path):
    """Mails, SLA records, errors and quarantine of a dry run are marked and don't count."""
    requests = flat(
        spark,
        flat_row("a", 1, duration_raw="-1"),
        flat_row("bad", 2, snowflake_database=""),
        flat_row("p", 3, status="PENDING", created_ms=AS_OF_MS - 30 * HOUR),
    )
    props = properties(spark, ("bob", "DEFAULT_ROLE", "BOBS_ROLE"))

    def live(store, run_id):
        from grantline.operators import outcomes

        catchup.run(store, requests, props, settings, run_id, outcomes.all_ok)
        tables = {"notifications": ("type", "urn"), "sla_notifications": ("action_request_urn",),
                  "quarantine": ("urn", "reason")}
        return {
            t: rows_of(store.read(t).where((F.col("run_id") == run_id) & ~F.col("dry_run")), *columns)
            for t, columns in tables.items()
        }

    alone = live(StateStore(spark, str(tmp_path / "alone")).ensure(), "live")
    assert len(alone["notifications"]) == 3 and len(alone["quarantine"]) == 1
    after = StateStore(spark, str(tmp_path / "after")).ensure()
    for n in range(2):
        catchup.run(after, requests, props, replace(settings, dry_run=True), f"dry{n}", None)
    marked = after.read("notifications")
    assert marked.count() > 0 and marked.where("not dry_run").count() == 0
    assert live(after, "live") == alone
