"""Fates of events: against a plain loop that remembers everything, and over the stream."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantline import schemas
from grantline.operators import outcomes
from grantline.sources.events import stream_events
from grantline.state.store import StateStore
from grantline.streaming import live as stream
from grantline.streaming.redelivery import COUNTS, Deliveries, Memory
from tests.builders import properties, rows_of
from tests.test_streaming import actions, event_rows, requests

HOUR = 3600
START = 1_700_000_000
CLOCK = (START + 60 * HOUR) * 1000
KIND = ("MetadataChangeLogEvent_v1", "actionRequest", "actionRequestStatus")


def batch(spark, rows):
    """Events ``id, urn, seconds`` after the start, any of them null."""
    data = [
        (i, *KIND, urn, None if at is None else (START + at) * 1_000_000) for i, urn, at in rows
    ]
    names = schemas.CHANGE_EVENTS.names
    frame = spark.createDataFrame(
        data, "event_id long, event_type string, entity_type string, aspect_name string,"
        " entity_urn string, us long",
    )
    return frame.withColumn("event_ts", F.timestamp_micros("us")).select(*names)


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "state")).ensure()


def counts(store):
    rows = store.spark.read.parquet(store.path("delivery_counts")).collect()
    return {r.run_id: {n: r[n] for n in COUNTS} for r in rows}


def plain(runs, keep_hours, clock_ms):
    """Per run: the counts, and the events to handle."""
    seen, mark, found = set(), None, []
    for rows in runs:
        oldest = None if mark is None else mark - keep_hours * HOUR
        number = dict.fromkeys(COUNTS, 0) | {"received": len(rows)}
        handled, fresh = [], set()
        for row in rows:
            if row[0] is None or row[2] is None:
                number["untracked"] += 1
                handled.append(row)
            elif oldest is not None and START + row[2] < oldest:
                number["late"] += 1
            elif row in seen or row in fresh:
                number["redelivered"] += 1
            else:
                number["fresh"] += 1
                fresh.add(row)
                handled.append(row)
        seen |= fresh
        times = [START + r[2] for r in fresh]
        if times:
            newest = min(max(times), clock_ms // 1000)
            mark = newest if mark is None else max(mark, newest)
        found.append((number, set(handled)))
    return found


@pytest.mark.parametrize("seed", range(2))
def test_random_deliveries(spark, settings, store, seed):
    dice = random.Random(seed)
    runs, sent = [], []
    for step in range(4):
        rows = []
        for _ in range(30):
            if sent and dice.random() < 0.4:
                rows += [dice.choice(sent)] * dice.randint(1, 3)
            else:
                at = dice.choice([step * 10 * HOUR, 0]) + dice.randint(0, 12 * HOUR)
                row = (dice.randint(0, 40), f"u{dice.randint(0, 9)}", at)
                rows.append(dice.choice([row, row, row, (None, "u1", at), (7, None, None)]))
        sent += rows
        runs.append(rows)
    deliveries = Deliveries(store, Memory(keep_hours=6))
    expected = plain(runs, 6, CLOCK)
    config = replace(settings, as_of_ms=CLOCK)
    for n, rows in enumerate(runs):
        handled = deliveries.receive(batch(spark, rows), f"run-{n}", config)
        got = [
            (r.event_id, r.entity_urn, None if r.s is None else r.s - START)
            for r in handled.withColumn("s", F.unix_seconds("event_ts")).collect()
        ]
        assert len(got) == len(set(got))
        assert set(got) == expected[n][1]
    assert counts(store) == {f"run-{n}": number for n, (number, _) in enumerate(expected)}
    total = deliveries.totals.read().first()
    assert {n: total[n] for n in COUNTS} == {
        n: sum(number[n] for number, _ in expected) for n in COUNTS
    }
    assert sum(number["late"] for number, _ in expected) > 0


def test_late_events_are_quarantined_once(spark, settings, store):
    deliveries = Deliveries(store, Memory(keep_hours=1))
    config = replace(settings, as_of_ms=CLOCK)
    deliveries.receive(batch(spark, [(1, "a", 10 * HOUR)]), "run-0", config)
    for run_id in ("run-1", "run-1", "run-2"):
        rows = [(2, "b", 0), (2, "b", 0), (3, "c", 9 * HOUR)]
        deliveries.receive(batch(spark, rows), run_id, config)
    assert rows_of(store.read("quarantine"), "urn", "reason", "detail") == [
        ("b", "late_event", f"2 {START * 1_000_000}")
    ]
    assert {k: (v["fresh"], v["redelivered"], v["late"]) for k, v in counts(store).items()} == {
        "run-0": (1, 0, 0),
        "run-1": (1, 0, 2),
        "run-2": (0, 1, 2),
    }


def test_memory_is_bounded(spark, settings, store):
    """However many runs there were, the hours on record are those of the memory."""
    deliveries = Deliveries(store, Memory(keep_hours=3))
    config = replace(settings, as_of_ms=CLOCK)
    for n in range(5):
        rows = [(n, f"u{n}", 2 * n * HOUR), (n, f"u{n}", 2 * n * HOUR)]
        deliveries.receive(batch(spark, rows), f"run-{n}", config)
        assert len(deliveries.hours()) <= 4
    assert deliveries.totals.read().first().fresh == 5


def test_a_time_after_the_clock_makes_nothing_late(spark, settings, store):
    deliveries = Deliveries(store, Memory(keep_hours=100))
    config = replace(settings, as_of_ms=CLOCK)
    for run_id, rows in (("run-0", [(1, "a", 10**8)]), ("run-1", [(2, "b", 0), (1, "a", 10**8)])):
        deliveries.receive(batch(spark, rows), run_id, config)
    assert counts(store)["run-1"] == dict.fromkeys(COUNTS, 0) | {
        "received": 2, "fresh": 1, "redelivered": 1
    }


def test_dry_and_empty_runs_remember_nothing(spark, settings, store):
    deliveries = Deliveries(store, Memory())
    dry = replace(settings, as_of_ms=CLOCK, dry_run=True)
    live = replace(settings, as_of_ms=CLOCK)
    deliveries.receive(batch(spark, [(1, "a", 0)]), "run-0", dry)
    assert deliveries.hours() == []
    assert deliveries.receive(batch(spark, []), "run-1", live).count() == 0
    assert deliveries.receive(batch(spark, [(1, "a", 0)]), "run-2", live).count() == 1
    with pytest.raises(ValueError, match="negative"):
        Memory(keep_hours=-1)


def test_stream_with_memory(spark, settings, store, tmp_path):
    folder = tmp_path / "events"
    config = replace(settings, as_of_ms=CLOCK)

    def run():
        stream.start(
            stream_events(spark, str(folder)), store, lambda changed: requests(spark),
            properties(spark, ("alice", "DEFAULT_ROLE", "HOME")), config,
            str(folder) + "-checkpoint", "live", outcomes.all_ok, Memory(keep_hours=1),
        ).awaitTermination()

    def send(*frames):
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(folder))

    send(event_rows(spark, "approved", "denied", "open"), event_rows(spark, "approved"))
    run()
    send(event_rows(spark, "denied", start=1), event_rows(spark, "second", start=-9_000))
    run()
    assert actions(store) == [("approved", "provision"), ("denied", "deny")]
    found = [counts(store)[f"live-{n:010d}"] for n in (0, 1)]
    assert [(c["received"], c["fresh"], c["redelivered"], c["late"], c["lost"]) for c in found] == [
        (4, 3, 1, 0, 0),
        (2, 0, 1, 1, 0),
    ]
    assert ("second", "late_event") in rows_of(store.read("quarantine"), "urn", "reason")
