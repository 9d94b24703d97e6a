from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantline.operators import outcomes
from grantline.plans import catchup
from grantline.state.store import StateStore
from tests.builders import DAY, HOUR, flat, flat_row, grants, no_errors, no_sla, properties, rows_of
from tests.conftest import AS_OF_MS


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state")).ensure()


def props(spark):
    return properties(spark, ("bob", "DEFAULT_ROLE", "BOBS_ROLE"))


def run(store, requests, settings, run_id, execute=outcomes.all_ok):
    return catchup.run(store, requests, props(store.spark), settings, run_id, execute)


def approve(store, requests, settings, run_id, execute=outcomes.all_ok):
    """Only the approval step of a run."""
    state = store.state(run_id, settings.count_dry_runs)
    catchup.approvals(store, state, requests, props(store.spark), settings, run_id, execute)
    return store.state(None, settings.count_dry_runs)


def decisions(store, run_id):
    frame = store.spark.read.parquet(f"{store.path('decisions')}/run_id={run_id}/step=approval")
    return rows_of(frame, "urn", "decision")


def sent(store, run_id, kind):
    rows = store.read("notifications").filter((F.col("run_id") == run_id) & (F.col("type") == kind))
    return [r[0] for r in rows_of(rows, "urn")]


def failing(codes):
    """Outcomes in which the named requests fail at their first statement."""

    def execute(statements):
        code = F.lit(None).cast("int")
        for urn, errno in codes.items():
            code = F.when(F.col("urn") == urn, F.lit(errno)).otherwise(code)
        return (
            statements.withColumn("errno", F.when(F.col("stmt_no") == 1, code))
            .withColumn("ok", F.col("errno").isNull())
            .withColumn("message", F.when(~F.col("ok"), F.lit("it failed")))
        )

    return execute


def later(settings, hours=1):
    return replace(settings, as_of_ms=settings.as_of_ms + hours * HOUR)


def test_decisions_of_a_first_run(spark, settings, store):
    store.import_state(
        grants(spark, ("ANALYST_ROLE", "PROD", "SALES", "held", None, AS_OF_MS, None, None)),
        no_sla(spark),
        no_errors(spark).unionByName(
            spark.sql("select 'failed' action_request_urn, '2003' snowflake_error_code, "
                      "'gone' error_message, timestamp'2020-01-01' failed_at")
        ),
    )
    requests = flat(
        spark,
        flat_row("new", 1),
        flat_row("held", 2),
        flat_row("failed", 3),
        flat_row("no database", 4, snowflake_database=""),
        flat_row("no role", 5, snowflake_role=None),
        flat_row("default role", 6, snowflake_role="", requestor_urn="urn:li:corpuser:bob"),
        flat_row("denied", 7, result="REJECTED"),
    )
    approve(store, requests, settings, "r1")
    assert decisions(store, "r1") == [
        ("default role", "provision"),
        ("failed", "skip_failed"),
        ("held", "skip_provisioned"),
        ("new", "provision"),
        ("no database", "skip_missing_fields"),
        ("no role", "skip_missing_fields"),
    ]
    assert rows_of(store.read("quarantine"), "urn", "reason") == [
        ("no database", "missing_database"),
        ("no role", "missing_role"),
    ]
    assert rows_of(store.read("metrics"), "decision", "requests", "statements") == [
        ("provision", 2, 8),
        ("skip_failed", 1, 0),
        ("skip_missing_fields", 2, 0),
        ("skip_provisioned", 1, 0),
    ]
    statements = store.read("statements").filter("urn = 'default role'")
    assert statements.count() == 4
    assert statements.filter("statement like '%TO ROLE BOBS_ROLE'").count() == 4
    assert sent(store, "r1", "approval") == ["default role", "new"]


def test_a_second_run_has_nothing_to_do(spark, settings, store):
    requests = flat(
        spark, flat_row("a", 1), flat_row("p", 2, status="PENDING", created_ms=AS_OF_MS - 30 * HOUR)
    )
    run(store, requests, settings, "r1")
    first = [r.asDict() for r in store.state().grants.collect()]
    run(store, requests, later(settings), "r2")
    assert [r.asDict() for r in store.state().grants.collect()] == first
    assert store.read("statements").filter("run_id = 'r2'").count() == 0
    assert store.read("notifications").filter("run_id = 'r2'").count() == 0
    assert sent(store, "r1", "warning") == ["p"]


def test_a_repeated_run_replaces_itself(spark, settings, store):
    requests = flat(spark, flat_row("a", 1), flat_row("b", 2, duration_raw="-1"))

    def everything():
        tables = ("statements", "notifications", "sla_notifications", "provisioning_errors")
        return [rows_of(store.read(t), *store.read(t).columns) for t in tables] + [
            rows_of(store.state().journal, "urn", "op")
        ]

    run(store, requests, settings, "r1")
    once = everything()
    run(store, requests, settings, "r1")
    assert everything() == once


def test_competing_requests_for_one_key(spark, settings, store, tmp_path):
    """The ledger grants each once; the latest-URN guard grants both on every pass."""
    requests = flat(spark, flat_row("a", 1), flat_row("b", 2))
    approve(store, requests, settings, "r1")
    approve(store, requests, later(settings), "r2")
    assert decisions(store, "r1") == [("a", "provision"), ("b", "provision")]
    assert decisions(store, "r2") == [("a", "skip_provisioned"), ("b", "skip_provisioned")]
    assert [r[0] for r in rows_of(store.state().grants, "latest_action_request_urn")] == ["b"]

    other = StateStore(spark, str(tmp_path / "latest")).ensure()
    latest = replace(settings, guard="latest")
    for n in range(2):
        approve(other, requests, later(latest, n), f"r{n}")
        assert decisions(other, f"r{n}") == [("a", "provision"), ("b", "provision")]


def test_expired_requests_are_granted_again_only_by_the_latest_guard(
    spark, settings, store, tmp_path
):
    requests = flat(spark, flat_row("a", 1, duration_raw="1"))
    other = StateStore(spark, str(tmp_path / "latest")).ensure()
    for target, config, again in (
        (store, settings, "skip_provisioned"),
        (other, replace(settings, guard="latest"), "provision"),
    ):
        run(target, requests, config, "r1")
        run(target, requests, later(config, 25), "r2")
        assert target.state().grants.first().revoked_at is not None
        assert sent(target, "r2", "revocation") == ["a"]
        run(target, requests, later(config, 26), "r3")
        assert decisions(target, "r3") == [("a", again)]


def test_durations(spark, settings, store):
    """Zero days never end; a negative duration is granted and revoked in one run."""
    requests = flat(
        spark,
        flat_row("zero", 1, snowflake_role="Z", duration_raw="0"),
        flat_row("minus", 2, snowflake_role="M", duration_raw="-1"),
        flat_row("none", 3, snowflake_role="N", duration_raw=None),
    )
    state = run(store, requests, settings, "r1")
    found = state.grants.select(
        "snowflake_role",
        F.col("expires_at").isNotNull().alias("ends"),
        F.col("revoked_at").isNotNull().alias("revoked"),
    )
    assert rows_of(found, "snowflake_role", "ends", "revoked") == [
        ("M", True, True), ("N", False, False), ("Z", False, False),
    ]


def test_failures(spark, settings, store):
    requests = flat(
        spark,
        flat_row("ok", 1, snowflake_role="A"),
        flat_row("permanent", 2, snowflake_role="B"),
        flat_row("transient", 3, snowflake_role="C"),
        flat_row("silent", 4, snowflake_role="D", requestor_email=None),
    )
    execute = failing({"permanent": 2003, "transient": 604, "silent": 2001})
    approve(store, requests, settings, "r1", execute)
    assert sent(store, "r1", "approval") == ["ok"]
    assert sent(store, "r1", "failure") == ["permanent", "silent"]
    errors = store.state().provisioning_errors
    assert rows_of(errors, "action_request_urn", "snowflake_error_code", "error_message") == [
        ("permanent", "2003", "it failed"),
        ("silent", "2001", "it failed"),
    ]
    approve(store, requests, later(settings), "r2")
    assert decisions(store, "r2") == [
        ("ok", "skip_provisioned"),
        ("permanent", "skip_failed"),
        ("silent", "skip_failed"),
        ("transient", "provision"),
    ]
    assert store.state().provisioning_errors.count() == 2


def test_a_failed_revoke_is_tried_again(spark, settings, store):
    requests = flat(spark, flat_row("a", 1, duration_raw="1"))
    run(store, requests, settings, "r1")
    run(store, requests, later(settings, 24), "r2", failing({"a": 2003}))
    assert store.state().grants.first().revoked_at is None
    assert store.state().provisioning_errors.count() == 0
    run(store, requests, later(settings, 25), "r3")
    assert store.state().grants.first().revoked_at is not None


def test_switches(spark, settings, store):
    requests = flat(spark, flat_row("a", 1, duration_raw="-1"))
    run(store, requests, replace(settings, expiry_enabled=False), "r1")
    assert store.state().grants.first().revoked_at is None
    quiet = replace(later(settings), revocation_notification=False)
    run(store, requests, quiet, "r2")
    assert store.state().grants.first().revoked_at is not None
    assert sent(store, "r2", "revocation") == []


def test_dry_runs_leave_no_lasting_state(spark, settings, store, tmp_path):
    requests = flat(spark, flat_row("a", 1, duration_raw="-1"))
    dry = replace(settings, dry_run=True)
    run(store, requests, dry, "r1")
    assert store.state().grants.count() == 0
    assert store.read("statements").filter("dry_run").count() == 8
    approve(store, requests, later(settings), "r2")
    assert decisions(store, "r2") == [("a", "provision")]

    counting = StateStore(spark, str(tmp_path / "counting")).ensure()
    approve(counting, requests, replace(dry, count_dry_runs=True), "r1")
    approve(counting, requests, replace(later(settings), count_dry_runs=True), "r2")
    assert decisions(counting, "r2") == [("a", "skip_provisioned")]


def test_unsafe_identifiers_can_be_held_back(spark, settings, store):
    requests = flat(
        spark, flat_row("a", 1, snowflake_schema="S; DROP ROLE X"), flat_row("b", 2)
    )
    approve(store, requests, replace(settings, check_identifiers=True), "r1")
    assert decisions(store, "r1") == [("a", "skip_unsafe_identifier"), ("b", "provision")]
    assert rows_of(store.read("quarantine"), "urn", "reason") == [("a", "unsafe_identifier")]


def test_keys_differ_by_case(spark, settings, store):
    requests = flat(
        spark, flat_row("a", 1, snowflake_role="R"), flat_row("b", 2, snowflake_role="r")
    )
    assert approve(store, requests, settings, "r1").grants.count() == 2


def test_requests_outside_the_window_are_left_alone(spark, settings, store):
    requests = flat(spark, flat_row("old", 1, created_ms=AS_OF_MS - 91 * DAY))
    assert approve(store, requests, settings, "r1").grants.count() == 0


def test_compaction_between_runs(spark, settings, store):
    requests = flat(spark, flat_row("a", 1), flat_row("b", 2, snowflake_role="OTHER"))
    approve(store, requests, settings, "r1")
    store.compact()
    approve(store, requests, later(settings), "r2")
    assert decisions(store, "r2") == [("a", "skip_provisioned"), ("b", "skip_provisioned")]
    assert store.state().grants.count() == 2


def refuse(statements):
    raise AssertionError("nothing may be executed")


def test_a_dry_run_executes_nothing(spark, settings, store):
    requests = flat(spark, flat_row("a", 1, duration_raw="-1"))
    run(store, requests, replace(settings, dry_run=True), "r1", refuse)
    assert store.read("statements").filter("dry_run").count() == 8


def test_durations_beyond_the_calendar_are_held_back(spark, settings, store):
    requests = flat(
        spark,
        flat_row("far", 1, duration_raw="10000000"),
        flat_row("past", 2, duration_raw="-10000000"),
        flat_row("ok", 3, duration_raw="30"),
    )
    for n in range(2):
        approve(store, requests, later(settings, n), f"r{n}")
    assert decisions(store, "r0") == [
        ("far", "skip_duration_out_of_range"),
        ("ok", "provision"),
        ("past", "skip_duration_out_of_range"),
    ]
    assert {r.urn for r in store.read("statements").collect()} == {"ok"}
    # Stored once, although the second run meets the same requests again.
    assert rows_of(store.read("quarantine"), "urn", "reason", "run_id") == [
        ("far", "duration_out_of_range", "r0"),
        ("past", "duration_out_of_range", "r0"),
    ]


def test_folded_generations_are_neither_listed_nor_kept(spark, settings, store):
    requests = flat(spark, flat_row("a", 1), flat_row("b", 2, snowflake_role="OTHER"))
    sizes = []
    for n in range(3):
        approve(store, requests, later(settings, n), f"r{n}")
        store.compact()
        store.drop_folded()
        sizes.append(len(store.state().journal.inputFiles()))
        assert decisions(store, f"r{n}") == [
            ("a", "provision" if n == 0 else "skip_provisioned"),
            ("b", "provision" if n == 0 else "skip_provisioned"),
        ]
    assert sizes[1] == sizes[2]
    assert store.state().grants.count() == 2


def test_run_ids_are_folder_names(spark, settings, store):
    with pytest.raises(ValueError, match="run id"):
        store.write("metrics", store.read("metrics"), "2024-01-01T00:30", "approval")


def test_shared_privileges_stay(spark, settings, store):
    """A revoke takes only what no other active grant of the role needs."""
    old = AS_OF_MS - DAY
    store.import_state(
        grants(
            spark,
            ("A", "D1", "S", "alone", None, 0, old, None),
            ("B", "D2", "S", "beside", None, 0, old, None),
            ("B", "D2", "T", "stays", None, 0, None, None),
            ("C", "D3", "S", "under", None, 0, old, None),
            ("C", "D3", "", "wide", None, 0, AS_OF_MS + DAY, None),
            ("D", "D4", "", "bare", None, 0, old, None),
            ("D", "D4", "S", "holds", None, 0, None, None),
            ("E", "D5", "S", "one", None, 0, old, None),
            ("E", "D5", "T", "two", None, 0, old, None),
            ("F", "D6", "S", "last", None, 0, old, None),
            ("F", "D6", "T", "gone", None, 0, None, old),
        ),
        no_sla(spark),
        no_errors(spark),
    )
    config = replace(settings, keep_shared_privileges=True)
    state = run(store, flat(spark), config, "r1")
    planned = store.read("statements").groupBy("urn").agg(
        F.count("*").alias("n"), F.max("stmt_no").alias("last")
    )
    assert rows_of(planned, "urn", "n", "last") == [
        ("alone", 4, 4), ("beside", 3, 3), ("last", 4, 4), ("one", 4, 4), ("two", 4, 4),
        ("under", 2, 2),
    ]
    revoked = state.grants.where("revoked_at is not null")
    # The one that shares everything needs no statement and is revoked, too.
    assert [r[0] for r in rows_of(revoked, "latest_action_request_urn")] == [
        "alone", "bare", "beside", "gone", "last", "one", "two", "under",
    ]
