"""Live status changes as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from grantline.operators.events import routed_events
from grantline.plans import catchup, intake, live
from grantline.settings import Settings
from grantline.sources.events import good_events, rejected_envelopes
from grantline.state.store import State, StateStore
from grantline.streaming.redelivery import Deliveries, Memory


def batch_run_id(prefix: str, batch_id: int) -> str:
    return f"{prefix}-{batch_id:010d}"


def handle_batch(
    store: StateStore,
    batch: DataFrame,
    find: Callable[[DataFrame], DataFrame],
    user_properties: DataFrame,
    settings: Settings,
    run_id: str,
    execute: Callable[[DataFrame], DataFrame],
    memory: Memory | None = None,
) -> None:
    """One micro-batch under one run id: a repeated batch replaces what it wrote.

    A batch of parsed envelopes (with a column ``problem``) has its rejects quarantined. ``find`` gives
    the requests of the changed URNs as they are now, for example by
    :func:`grantline.sources.requests.bucket_lookup`. With a ``memory``, events that an earlier run
    handled are left out and late ones quarantined.
    """
    # Written first: the micro-batch is computed once, whatever is done with it.
    events = batch
    if "problem" in batch.columns:
        events = good_events(batch)
        intake.quarantine_rejected(
            store, rejected_envelopes(batch), run_id, "envelopes", settings.dry_run
        )
    if memory:
        events = Deliveries(store, memory).receive(routed_events(events), run_id, settings)
    changed = store.write("changes", live.changes(events), run_id, "live")
    state = _state_of(store, changed, settings, run_id)
    decided = store.write(
        "decisions",
        live.decide(changed, find(changed), state, user_properties, settings),
        run_id,
        "live",
    )
    catchup.settle_approvals(store, decided, settings, run_id, execute, live=True)
    sent = store.matching("denials", changed, "urn", run_id, settings.count_dry_runs)
    mails = store.write(
        "notifications",
        live.denials(decided, sent.withColumn("type", F.lit("denial")), settings),
        run_id,
        "denial",
        settings.dry_run,
    )
    store.write("denials", mails.select("urn").distinct(), run_id, "denial", settings.dry_run)


def _state_of(store: StateStore, changed: DataFrame, settings: Settings, run_id: str) -> State:
    """The state that matters to a batch: errors and granted URNs of its requests only."""
    store.fold(run_id)
    dry = settings.count_dry_runs
    keys = changed.select(F.col("urn").alias("action_request_urn"))
    return replace(
        store.state(run_id, dry),
        provisioning_errors=store.matching(
            "provisioning_errors", keys, "action_request_urn", run_id, dry
        ),
        granted_urns=store.granted_among(changed, run_id, dry),
    )


def start(
    stream: DataFrame,
    store: StateStore,
    find: Callable[[DataFrame], DataFrame],
    user_properties: DataFrame,
    settings: Settings | Callable[[], Settings],
    checkpoint: str,
    prefix: str,
    execute: Callable[[DataFrame], DataFrame],
    memory: Memory | None = None,
) -> StreamingQuery:
    """Handle everything that has arrived, then stop: one scheduled invocation.

    ``stream`` has events, or envelopes as :func:`grantline.sources.events.from_envelopes` parses
    them. Redelivered and late events do no harm and none is dropped: the state guards
    against them in every batch. With a ``memory`` they are told apart and counted, see
    :mod:`grantline.streaming.redelivery`.
    ``prefix`` names the runs of this stream: one for each checkpoint folder.
    ``settings`` may be a function, so that each batch gets the clock of its start.
    """
    store.ensure()

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        now = settings() if callable(settings) else settings
        handle_batch(
            store,
            batch,
            find,
            user_properties,
            now,
            batch_run_id(prefix, batch_id),
            execute,
            memory,
        )

    wanted = stream if "problem" in stream.columns else routed_events(stream)
    return (
        wanted.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
