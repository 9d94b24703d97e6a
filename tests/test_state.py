import random
from dataclasses import replace

from pyspark.sql import functions as F

from grantline import schemas
from grantline.settings import Settings, StateNames
from grantline.state import journal as j
from grantline.state.store import StateStore, state_ddl
from tests.builders import DAY, grants, no_errors, no_sla, rows_of
from tests.conftest import AS_OF_MS

VIEW = (
    "snowflake_role", "snowflake_database", "snowflake_schema",
    "latest_action_request_urn", "requestor_email",
)


def granted(spark, *rows):
    """(seq, urn, role, database, schema, email, expires_ms) rows of granted requests."""
    return spark.createDataFrame(
        list(rows),
        "seq long, urn string, resolved_role string, snowflake_database string, "
        "snowflake_schema string, resolved_email string, expires_at_ms long",
    )


def view(frame):
    return rows_of(
        frame.select(
            *VIEW, *[F.unix_millis(c).alias(c) for c in ("granted_at", "expires_at", "revoked_at")]
        ),
        *VIEW, "granted_at", "expires_at", "revoked_at",
    )


def test_extension_keeps_one_row_with_the_new_timer(spark, settings):
    first = j.grant_rows(
        granted(spark, (0, "u1", "R", "D", "S", "a@b.c", AS_OF_MS + 5 * DAY)), settings, "1"
    )
    later = replace(settings, as_of_ms=AS_OF_MS + DAY)
    second = j.grant_rows(
        granted(spark, (0, "u2", "R", "D", "S", None, AS_OF_MS + 60 * DAY)), later, "2"
    )
    assert view(j.current_grants(first.unionByName(second))) == [
        ("R", "D", "S", "u2", None, AS_OF_MS + DAY, AS_OF_MS + 60 * DAY, None)
    ]


def test_no_schema_is_stored_as_empty_text_and_read_as_null(spark, settings):
    rows = granted(
        spark,
        (0, "u1", "R", "D", None, None, AS_OF_MS),
        (1, "u2", "R", "E", "", None, AS_OF_MS),
        (2, "u3", "R", "F", "S", None, AS_OF_MS),
    )
    grants_view = j.current_grants(j.grant_rows(rows, settings, "1"))
    assert [r[2] for r in view(grants_view)] == ["", "", "S"]
    found = j.expired_grants(grants_view, settings)
    assert rows_of(found, "snowflake_database", "snowflake_schema") == [
        ("D", None), ("E", None), ("F", "S"),
    ]


def test_expired_is_inclusive_and_skips_revoked_and_endless(spark, settings):
    frame = grants(
        spark,
        ("R", "now", "", "a", None, 0, AS_OF_MS, None),
        ("R", "past", "", "b", None, 0, AS_OF_MS - 1000, None),
        ("R", "future", "", "c", None, 0, AS_OF_MS + 1000, None),
        ("R", "endless", "", "d", None, 0, None, None),
        ("R", "revoked", "", "e", None, 0, AS_OF_MS - 1000, AS_OF_MS - 500),
    )
    found = j.expired_grants(frame, settings)
    assert rows_of(found, "snowflake_database") == [("now",), ("past",)]


def test_journal_equals_merge_and_update(spark):
    """Random histories: the view against rows changed in place."""
    rng = random.Random(3)
    table, journal = {}, None
    for run in range(6):
        now = AS_OF_MS + run * DAY + rng.randint(0, 999)
        config = Settings(as_of_ms=now)
        rows = [
            (seq, f"r{run}u{seq}", rng.choice("AB"), rng.choice("XY"), rng.choice([None, "", "S"]),
             rng.choice([None, "a@b.c"]), rng.choice([None, now - 1, now + 2 * DAY]))
            for seq in range(rng.randint(0, 5))
        ]
        second = now // 1000 * 1000
        for _, urn, role, db, schema, email, expires in rows:
            end = expires and expires // 1000 * 1000
            table[role, db, schema or ""] = [urn, email, second, end, None]
        new = j.grant_rows(granted(spark, *rows), config, f"{run}")
        journal = new if journal is None else journal.unionByName(new)
        due = j.expired_grants(j.current_grants(journal), config)
        keyed = due.withColumn("snowflake_schema", F.coalesce("snowflake_schema", F.lit("")))
        journal = journal.unionByName(j.revoke_rows(keyed, config, f"{run}"))
        for row in table.values():
            if row[3] is not None and row[3] <= now and row[4] is None:
                row[4] = second
        expected = sorted(
            ((*key, *row) for key, row in table.items()),
            key=lambda r: tuple((v is None, str(v)) for v in r),
        )
        assert view(j.current_grants(journal)) == expected


def test_insert_absent_keeps_the_first_entry(spark, settings):
    old = spark.createDataFrame([("u1", "2003")], "action_request_urn string, code string")
    new = spark.createDataFrame(
        [("u1", "2001"), ("u2", "2001")], "action_request_urn string, code string"
    )
    found = j.insert_absent(old, new, ["action_request_urn"])
    assert rows_of(found, "action_request_urn", "code") == [("u2", "2001")]


def store_with(spark, tmp_path, *rows):
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    store.import_state(grants(spark, *rows), no_sla(spark), no_errors(spark))
    return store


def test_empty_store(spark, tmp_path):
    state = StateStore(spark, str(tmp_path / "state")).ensure().state("r")
    assert state.grants.count() == 0 and state.granted_urns.count() == 0
    assert state.sla_notifications.schema.names == schemas.SLA_NOTIFICATIONS.names
    assert state.provisioning_errors.count() == 0


def test_imported_rows_are_older_than_any_run(spark, settings, tmp_path):
    future = AS_OF_MS + 90 * DAY
    store = store_with(spark, tmp_path, ("R", "D", "", "old", None, future, None, future))
    new = j.grant_rows(granted(spark, (0, "new", "R", "D", "", None, None)), settings, "r1")
    store.write("journal", new, "r1", "approval")
    assert [r[3] for r in view(store.state().grants)] == ["new"]


def test_a_run_does_not_see_its_own_earlier_attempt(spark, settings, tmp_path):
    store = store_with(spark, tmp_path)
    for urns in (["a", "b"], ["c"]):
        rows = [(i, u, "R", u, "", None, None) for i, u in enumerate(urns)]
        store.write("journal", j.grant_rows(granted(spark, *rows), settings, "r1"), "r1", "approval")
        assert store.state("r1").granted_urns.count() == 0
    assert rows_of(store.state("r2").granted_urns, "urn") == [("c",)]


def test_compaction_changes_nothing_for_readers(spark, settings, tmp_path):
    store = store_with(spark, tmp_path, ("R", "D", "", "u0", "x@y.z", 0, AS_OF_MS, None))

    def add(run, *rows, dry=False):
        config = replace(settings, as_of_ms=AS_OF_MS + int(run) * 1000, dry_run=dry)
        store.write("journal", j.grant_rows(granted(spark, *rows), config, run), run, "approval")

    def seen(**options):
        state = store.state(**options)
        return view(state.grants), rows_of(state.granted_urns, "urn")

    add("1", (0, "u1", "R", "D", "", None, None), (1, "u2", "R", "D", "", None, None))
    add("2", (0, "dry", "R", "D", "", None, None), dry=True)
    before, with_dry = seen(), seen(include_dry=True)
    assert before[1] == [("u0",), ("u1",), ("u2",)] and before[0][0][3] == "u2"
    assert with_dry[0][0][3] == "dry"
    store.compact()
    assert (seen(), seen(include_dry=True)) == (before, with_dry)
    assert store.generation() == 1
    add("3", (0, "u3", "R", "D", "", None, None))
    after = seen()
    assert after[0][0][3] == "u3" and after[1] == [("u0",), ("u1",), ("u2",), ("u3",)]
    store.compact()
    assert seen() == after and store.generation() == 2


def test_state_tables_in_a_catalog(spark, settings):
    config = replace(settings, state=StateNames("spark_catalog", "access_state"))
    assert config.state.qualified_sla_table == "spark_catalog.access_state.ACCESS_SLA_NOTIFICATIONS"
    spark.sql("CREATE DATABASE IF NOT EXISTS access_state")
    try:
        for _ in range(2):
            for statement in state_ddl(config):
                spark.sql(statement)
        table = spark.table(config.state.qualified_grants_table)
        assert table.schema.names == schemas.GRANTS.names and table.count() == 0
        assert spark.sql("SHOW TABLES IN access_state").count() == 3
    finally:
        spark.sql("DROP DATABASE access_state CASCADE")


def test_settings_from_a_configuration_mapping():
    config = Settings.from_mapping(
        {
            "sla": {"warning_after_hours": 8, "escalation_recipients": ["lead@example.com"]},
            "expiry": {"enabled": False},
            "provisioning": {"default_warehouse": "WH", "requestor_username_format": "email_local_part"},
            "state": {"database": "OPS", "grants_table": "G"},
            "lookback_days": 30,
            "field_snowflake_role": "role",
            "smtp": {"host": "localhost"},
        },
        AS_OF_MS,
        guard="latest",
    )
    assert (config.warning_after_hours, config.escalation_after_hours) == (8, 72)
    assert config.escalation_recipients == ("lead@example.com",)
    assert not config.expiry_enabled and config.revocation_notification
    assert config.fields.role == "role" and config.fields.database == "snowflake_database"
    assert config.state.qualified_grants_table == "OPS.ACCESS.G"
    assert config.username_format == "email_local_part" and config.guard == "latest"
    assert config.since_ms == AS_OF_MS - 30 * DAY
