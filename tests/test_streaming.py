from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantline.operators import events, outcomes
from grantline.plans import live
from grantline.sources.events import (
    from_envelopes,
    good_events,
    rejected_envelopes,
    stream_events,
)
from grantline.state.store import StateStore
from grantline.streaming import live as stream
from tests.builders import flat, flat_row, grants, no_errors, no_sla, properties, rows_of

CHANGE = "MetadataChangeLogEvent_v1"
STATUS = "actionRequestStatus"


def event_rows(spark, *urns, start=0, kind=CHANGE, entity="actionRequest", aspect=STATUS):
    rows = [(start + i, kind, entity, aspect, urn) for i, urn in enumerate(urns)]
    frame = spark.createDataFrame(
        rows,
        "event_id long, event_type string, entity_type string, aspect_name string, "
        "entity_urn string",
    )
    return frame.withColumn("event_ts", F.timestamp_seconds(F.col("event_id") + 1_700_000_000))


def requests(spark):
    return flat(
        spark,
        flat_row("approved", 1),
        flat_row("second", 2, created_ms=5),
        flat_row("denied", 3, result="REJECTED", note="No"),
        flat_row("open", 4, status="PENDING", result=None),
        flat_row("other", 5, request_type="TAG_ASSOCIATION"),
        flat_row("bare", 6, snowflake_database=None),
    )


def props(spark):
    return properties(spark, ("alice", "DEFAULT_ROLE", "HOME"))


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state")).ensure()


def test_routing(spark):
    frame = event_rows(spark, "u1", None, "")
    for other in (
        event_rows(spark, "u2", kind="EntityChangeEvent_v1"),
        event_rows(spark, "u3", aspect="actionRequestInfo"),
        event_rows(spark, "u4", entity="dataset"),
    ):
        frame = frame.unionByName(other)
    assert rows_of(events.routed_events(frame), "entity_urn") == [("u1",)]


def test_live_decisions(spark, settings, store):
    frame = event_rows(
        spark, "second", "approved", "denied", "open", "other", "bare", "approved", "nowhere"
    )
    decided = live.decide(live.changes(frame), requests(spark), store.state(), props(spark), settings)
    assert rows_of(decided, "urn", "decision", "events", "seq") == [
        ("approved", "provision", 2, 1),
        ("bare", "skip_missing_fields", 1, 5),
        ("denied", "deny", 1, 2),
        ("open", "ignore_status", 1, 3),
        ("other", "ignore_type", 1, 4),
        ("second", "provision", 1, 0),
    ]
    changed = events.changed_urns(events.routed_events(frame))
    assert rows_of(events.unmatched_urns(changed, requests(spark)), "urn") == [("nowhere",)]


def test_live_pass_consults_errors_only_when_asked(spark, settings, store):
    errors = spark.sql(
        "select 'approved' action_request_urn, '2003' snowflake_error_code, 'x' error_message, "
        "timestamp'2020-01-01' failed_at"
    )
    store.write("provisioning_errors", errors, "r0", "import")
    frame = event_rows(spark, "approved")
    for check, expected in ((False, "provision"), (True, "skip_failed")):
        config = replace(settings, check_failures_live=check)
        decided = live.decide(live.changes(frame), requests(spark), store.state(), props(spark), config)
        assert rows_of(decided, "urn", "decision") == [("approved", expected)]


@pytest.mark.parametrize(
    ("order", "first"),
    [(("approved", "second"), "skip_provisioned"), (("second", "approved"), "provision")],
)
def test_latest_guard_follows_the_order_of_events(spark, settings, store, order, first):
    """The row of "approved" is overwritten only if "second" comes before it."""
    held = ("ANALYST_ROLE", "PROD", "SALES", "approved", None, 0, None, None)
    store.import_state(grants(spark, held), no_sla(spark), no_errors(spark))
    config = replace(settings, guard="latest")
    frame = event_rows(spark, *order, "denied")
    decided = live.decide(live.changes(frame), requests(spark), store.state(), props(spark), config)
    assert rows_of(decided, "urn", "decision") == [
        ("approved", first),
        ("denied", "deny"),
        ("second", "provision"),
    ]


def run_stream(spark, store, folder, settings):
    query = stream.start(
        stream_events(spark, str(folder), max_files_per_trigger=1),
        store,
        lambda changed: requests(spark),
        props(spark),
        settings,
        str(folder) + "-checkpoint",
        "live",
        outcomes.all_ok,
    )
    query.awaitTermination()
    return query


def actions(store):
    granted = store.state().journal.select("urn", F.lit("provision").alias("action"))
    denied = store.read("notifications").filter("type = 'denial'")
    return rows_of(
        granted.unionByName(denied.select("urn", F.lit("deny").alias("action"))), "urn", "action"
    )


EXPECTED = [("approved", "provision"), ("denied", "deny"), ("second", "provision")]


def test_stream_handles_redelivery_and_restart(spark, settings, store, tmp_path):
    folder = tmp_path / "events"
    event_rows(spark, "approved", "denied", "open").coalesce(1).write.parquet(str(folder))
    event_rows(spark, "approved", "denied", start=10).coalesce(1).write.mode("append").parquet(
        str(folder)
    )
    run_stream(spark, store, folder, settings)
    assert actions(store) == EXPECTED[:2]
    event_rows(spark, "second", "approved", start=20).coalesce(1).write.mode("append").parquet(
        str(folder)
    )
    run_stream(spark, store, folder, settings)
    assert actions(store) == EXPECTED
    run_stream(spark, store, folder, settings)
    assert actions(store) == EXPECTED


def test_stream_equals_one_batch(spark, settings, store, tmp_path):
    frame = event_rows(spark, "approved", "denied", "second", "open", "approved", "denied")
    folder = tmp_path / "events"
    frame.repartitionByRange(3, "event_id").write.parquet(str(folder))
    run_stream(spark, store, folder, settings)
    before = StateStore(spark, str(tmp_path / "before")).ensure().state()
    decided = live.decide(live.changes(frame), requests(spark), before, props(spark), settings)
    batch = [(u, d) for u, d in rows_of(decided, "urn", "decision") if d in ("provision", "deny")]
    assert actions(store) == batch


def test_a_repeated_batch_replaces_itself(spark, settings, store):
    batch = event_rows(spark, "approved", "denied")
    for _ in range(2):
        stream.handle_batch(
            store, batch, lambda changed: requests(spark), props(spark), settings, "live-0", outcomes.all_ok
        )
        assert actions(store) == EXPECTED[:2]
        assert store.read("statements").count() == 4


def test_an_interrupted_batch_is_completed(spark, settings, store):
    """A failure after the grants were recorded does not lose the mails."""
    batch = event_rows(spark, "approved")

    class Stop(Exception):
        pass

    write = store.write

    def broken(table, *rest):
        if table == "notifications":
            raise Stop
        return write(table, *rest)

    store.write = broken
    with pytest.raises(Stop):
        stream.handle_batch(
            store, batch, lambda changed: requests(spark), props(spark), settings, "b0", outcomes.all_ok
        )
    store.write = write
    assert store.state().journal.count() == 1
    stream.handle_batch(
        store, batch, lambda changed: requests(spark), props(spark), settings, "b0", outcomes.all_ok
    )
    assert store.state().journal.count() == 1
    assert store.read("notifications").filter("type = 'approval'").count() == 1


def test_denials_can_be_mailed_for_every_event(spark, settings, store):
    each = replace(settings, dedup_denials=False)
    batch = event_rows(spark, "denied", "denied", "denied")
    for run_id, config, total in (("b0", settings, 1), ("b1", settings, 1), ("b2", each, 4)):
        stream.handle_batch(
            store, batch, lambda changed: requests(spark), props(spark), config, run_id, outcomes.all_ok
        )
        assert store.read("notifications").filter("type = 'denial'").count() == total


def test_envelopes(spark):
    """The wire shape of an event; damaged ones become quarantine rows."""
    texts = [
        '{"event_type":"E","event":{"entityType":"t","aspectName":"a","entityUrn":"u"}}',
        '{"event_type":"E","event":{"entityType":"t"}}',
        '{"event":{"entityUrn":"u"}}',
        '{"event_type":"E"}',
        '{"event_type":',
        "[]",
        None,
    ]
    raw = spark.createDataFrame(list(enumerate(texts)), "offset long, value string")
    parsed = from_envelopes(raw, F.col("offset"), F.timestamp_seconds(F.col("offset")))
    assert rows_of(good_events(parsed), "event_id", "event_type", "entity_urn") == [
        (0, "E", "u"),
        (1, "E", None),
    ]
    assert rows_of(parsed.filter("problem is not null"), "event_id", "problem") == [
        (2, "missing:event_type"),
        (3, "missing:event"),
        (4, "malformed_envelope"),
        (5, "malformed_envelope"),
        (6, "malformed_envelope"),
    ]
    assert rejected_envelopes(parsed).columns == ["urn", "reason", "detail"]


def test_history_is_filtered_to_the_batch_before_anything_else(spark, settings, store):
    """Semi-joins with the batch cut the history."""
    known = spark.createDataFrame([("someone",)], "urn string")
    store.write("denials", known, "b0", "denial")
    batch = event_rows(spark, "approved")
    changed = live.changes(batch)
    decided = live.decide(changed, requests(spark), store.state(), props(spark), settings)
    sent = store.matching("denials", changed, "urn", "b1")
    mails = live.denials(decided, sent.withColumn("type", F.lit("denial")), settings)

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "LeftSemi" in plan(decided.filter("provisioned"))
    assert "LeftSemi" in plan(mails)


def test_a_stream_of_envelopes(spark, settings, store, tmp_path):
    """Text lines to decisions; envelopes that can't be read are quarantined, each once."""
    folder = tmp_path / "lines"
    event = '"event":{"entityType":"actionRequest","aspectName":"actionRequestStatus","entityUrn":"%s"}'
    lines = [f'{{"event_type":"{CHANGE}",{event % urn}}}' for urn in ("approved", "denied", "open")]
    frame = spark.createDataFrame([(x,) for x in [*lines, '{"event_type":', "[]"]], "value string")
    for _ in range(2):
        frame.coalesce(1).write.mode("append").text(str(folder))
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
    parsed = from_envelopes(raw, F.xxhash64("value"), F.timestamp_seconds(F.lit(1_700_000_000)))
    stream.start(
        parsed, store, lambda changed: requests(spark), props(spark), settings,
        str(tmp_path / "checkpoint"), "live", outcomes.all_ok,
    ).awaitTermination()
    assert actions(store) == EXPECTED[:2]
    assert rows_of(store.read("quarantine"), "reason", "detail") == [
        ("malformed_envelope", "[]"), ("malformed_envelope", '{"event_type":'),
    ]
