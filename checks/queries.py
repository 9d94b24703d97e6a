"""One query per operator or pass, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from grantline import schemas
from grantline.checkpoints import scratch_path
from grantline.functions import clock, forms, identity
from grantline.functions import statements as texts
from grantline.operators.skew import lookup_join
from grantline.operators import (
    conformance,
    decisions,
    events,
    guards,
    metrics,
    notices,
    outcomes,
    privileges,
    quarantine,
    requests,
    roles,
    sequence,
    sla,
    statements,
)
from grantline.plans import approval, catchup, deferred, expiry, intake, live
from grantline.plans import sla as sla_plan
from grantline.settings import Settings
from grantline.sources import events as event_source
from grantline.sources import forms as form_source
from grantline.sources import requests as request_source
from grantline.sources.events import stream_events
from grantline.state import journal as j
from grantline.state.store import State, StateStore
from grantline.streaming import live as live_stream
from grantline.streaming import redelivery
from grantline.streaming.redelivery import Deliveries, Memory

S = fx.SETTINGS
LATEST = replace(S, guard="latest")
SHARED = replace(S, keep_shared_privileges=True)
RUN = "run-1"
#: Lines of one file of a listing, from some hundred thousand requests on.
LISTING_ROWS = 100_000

Query = Callable[[SparkSession, str], DataFrame]


def _ms(column: str, name: str) -> Column:
    return clock.timestamp_ms(F.col(column)).alias(name)


def _approved(spark: SparkSession, d: str) -> DataFrame:
    return requests.approved_requests(fx.flat_requests(spark, d), S)


def _state(spark: SparkSession, d: str) -> State:
    journal = j.journal_of(fx.grants(spark, d))
    return State(
        journal=journal,
        granted_urns=journal.select("urn").distinct(),
        sla_notifications=fx.sla_notifications(spark, d),
        provisioning_errors=fx.provisioning_errors(spark, d),
    )


def _properties(spark: SparkSession, d: str) -> DataFrame:
    return fx.user_properties(spark, d)


def _decided(
    spark: SparkSession, d: str, settings: Settings = S, state: State | None = None
) -> DataFrame:
    return approval.decide(
        fx.flat_requests(spark, d), state or _state(spark, d), _properties(spark, d), settings
    )


def _results(spark: SparkSession, d: str, state: State | None = None) -> DataFrame:
    decided = _decided(spark, d, S, state)
    return approval.results(decided, fx.execute(approval.plan(decided, S)), S)


def _settled(spark: SparkSession, d: str, state: State | None = None) -> approval.Settled:
    return approval.settle(_results(spark, d, state), S, RUN)


def _live_decided(spark: SparkSession, d: str) -> DataFrame:
    changed = live.changes(fx.change_events(spark, d))
    return live.decide(
        changed,
        requests.lookup(fx.flat_requests(spark, d), changed),
        _state(spark, d),
        _properties(spark, d),
        S,
    )


def _grant_columns(grants: DataFrame) -> DataFrame:
    return grants.select(
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        F.col("latest_action_request_urn").alias("urn"),
        "requestor_email",
        _ms("granted_at", "granted_ms"),
        _ms("expires_at", "expires_ms"),
        _ms("revoked_at", "revoked_ms"),
    )


def _notice_columns(mails: DataFrame, *payload: str) -> DataFrame:
    return mails.select(
        "type",
        "urn",
        F.array_join("to", ",").alias("recipients"),
        F.array_join("cc", ",").alias("copies"),
        "subject",
        "deliverable",
        *[F.col("payload")[name].alias(f"p_{name}") for name in payload],
    )


def q01_approved_scan(spark: SparkSession, d: str) -> DataFrame:
    return _approved(spark, d).select("seq", "urn", "created_ms", "requestor_urn")


def _write_listing(lines: DataFrame, path: str, rows: int) -> None:
    """Lines in listing order, in five files or more: a file is sorted by one task, so their number
    follows that of the ``rows``."""
    dealt = lines.repartitionByRange(max(5, rows // LISTING_ROWS), "seq")
    dealt.sortWithinPartitions("seq").select("value").write.text(path)


def q01_json_catchup(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on a listing of JSON files, by line number; damaged lines with their reason."""
    rows = fx.nested_requests(spark, d)
    text = F.to_json(F.struct(*[c for c in rows.columns if c != "seq"]))
    kind = F.col("seq") % 40
    damaged = (
        F.when(kind == 1, F.substring(text, 1, 40))
        .when(kind == 4, F.regexp_replace(text, '"status":"[A-Z]+",', ""))
        .otherwise(text)
    )
    store = state_store(spark, d, "json")
    path = f"{store.root}/listing"
    _write_listing(rows.select("seq", damaged.alias("value")), path, rows.count())
    flat = intake.json_listing(store, path, S, RUN)
    decided = approval.decide(flat, store.state(RUN), _properties(spark, d), S)
    rejected = store.read("quarantine").filter(F.col("step") == "listing")
    return decided.select("seq", "urn", "decision").unionByName(
        rejected.groupBy(F.col("reason").alias("decision")).agg(
            F.count("*").alias("seq"), F.lit(None).cast("string").alias("urn")
        )
    )


def q02_pending_scan(spark: SparkSession, d: str) -> DataFrame:
    pending = requests.pending_requests(fx.flat_requests(spark, d))
    return pending.select(
        "urn",
        "created_ms",
        "requestor_urn",
        "requestor_email",
        "resource",
        F.array_join("assigned_users", ",").alias("assigned_users"),
        F.array_join("assigned_groups", ",").alias("assigned_groups"),
    )


def q03_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    wanted = events.changed_urns(fx.change_events(spark, d).filter("entity_urn <> ''"))
    found = requests.lookup(fx.flat_requests(spark, d), wanted)
    return found.select("urn", "request_type", "status", "result")


def q04_schema_check(spark: SparkSession, d: str) -> DataFrame:
    rows = request_source.checked(fx.json_requests(spark, d))
    reason = F.coalesce("reason", F.lit("ok")).alias("reason")
    return rows.groupBy(reason).agg(
        F.count("*").alias("n"),
        F.sum(F.col("created.time")).alias("created_sum"),
        F.sum(F.size(F.col("params.workflowFormRequest.fields"))).alias("fields"),
    )


def q11_value_union(spark: SparkSession, d: str) -> DataFrame:
    pairs = forms.field_pairs(F.col("params.workflowFormRequest.fields"))
    return (
        fx.nested_requests(spark, d)
        .select("urn", pairs.alias("pairs"))
        .select("urn", F.explode(forms.raw_map(F.col("pairs"))).alias("field", "value"))
    )


def q13_form_map(spark: SparkSession, d: str) -> DataFrame:
    return requests.flatten(fx.nested_requests(spark, d), S).select(
        "urn",
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        "duration_raw",
        "requestor_email",
        "justification",
    )


def q15_duration(spark: SparkSession, d: str) -> DataFrame:
    raw = F.col("duration_raw")
    return fx.flat_requests(spark, d).select(
        "urn",
        "duration_raw",
        forms.duration_days(raw).alias("days"),
        forms.duration_problem(raw).alias("problem"),
    )


def q16_flatten(spark: SparkSession, d: str) -> DataFrame:
    return requests.flatten(fx.nested_requests(spark, d), S).select(
        "seq",
        "urn",
        "request_type",
        "status",
        "result",
        "note",
        "resource",
        "requestor_urn",
        "created_ms",
        "due_date_ms",
        "access_duration_days",
    )


def q18_identity(spark: SparkSession, d: str) -> DataFrame:
    urn = F.col("requestor_urn")
    return fx.flat_requests(spark, d).select(
        "urn",
        identity.username(urn).alias("username"),
        identity.username(urn, "email_local_part").alias("local_part"),
        identity.email_from_urn(urn).alias("urn_email"),
        identity.resolved_email(F.col("requestor_email"), urn).alias("resolved_email"),
    )


def q21_expiry_ts(spark: SparkSession, d: str) -> DataFrame:
    expires = clock.expiry_ms(fx.AS_OF_MS + 789, F.col("access_duration_days"))
    stored = clock.seconds_timestamp(F.col("expires_ms"))
    return (
        fx.flat_requests(spark, d)
        .select("urn", expires.alias("expires_ms"))
        .select(
            "urn",
            "expires_ms",
            F.date_format(stored, "yyyy-MM-dd HH:mm:ss").alias("stored"),
            clock.timestamp_ms(stored).alias("stored_ms"),
        )
    )


def q28_event_filter(spark: SparkSession, d: str) -> DataFrame:
    return events.routed_events(fx.change_events(spark, d)).select("event_id", "entity_urn")


def q28_event_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Routed events read from JSON envelopes, and the envelopes that can't be read."""
    rows = fx.change_events(spark, d)
    inner = F.struct(
        F.col("entity_type").alias("entityType"),
        F.col("aspect_name").alias("aspectName"),
        F.col("entity_urn").alias("entityUrn"),
    )
    text = F.to_json(F.struct("event_type", inner.alias("event")))
    cut = F.when(F.col("event_id") % 10 == 3, F.substring(text, 1, 20)).otherwise(text)
    raw = rows.select("event_id", "event_ts", cut.alias("value"))
    parsed = event_source.from_envelopes(raw, F.col("event_id"), F.col("event_ts"))
    good = events.routed_events(event_source.good_events(parsed))
    bad = parsed.filter("problem is not null")
    return good.select(F.lit(None).cast("string").alias("problem"), "event_id", "entity_urn").unionByName(
        bad.select("problem", "event_id", "entity_urn")
    )


def q29_provisionable(spark: SparkSession, d: str) -> DataFrame:
    resolved = roles.resolve_roles(
        _approved(spark, d), roles.default_roles(_properties(spark, d)), S
    )
    reason = F.coalesce(decisions.missing_reason(), F.lit("ready"))
    return resolved.select("urn", reason.alias("reason"))


def q30_expired(spark: SparkSession, d: str) -> DataFrame:
    return _grant_columns(expiry.expired(_state(spark, d).grants, S)).drop("revoked_ms")


def q30_due_calendar(spark: SparkSession, d: str) -> DataFrame:
    """The same from the hours of a snapshot's calendar that are over, and nothing else of it."""
    store = state_store(spark, d, "calendar")
    store.compact()
    store.drop_folded()
    ended = expiry.expired(j.current_grants(store.due_rows(S, RUN)), S)
    return _grant_columns(ended).drop("revoked_ms")


def q34_not_provisioned(spark: SparkSession, d: str) -> DataFrame:
    return guards.not_provisioned(_approved(spark, d), _state(spark, d).grants).select(
        "seq", "urn"
    )


def q35_not_failed(spark: SparkSession, d: str) -> DataFrame:
    errors = fx.provisioning_errors(spark, d)
    return guards.not_failed(_approved(spark, d), errors).select("seq", "urn")


def q36_sla_dedup(spark: SparkSession, d: str) -> DataFrame:
    due = sla_plan.due(fx.flat_requests(spark, d), fx.sla_notifications(spark, d), S)
    return due.select("urn", "sla_class")


def q37_default_roles(spark: SparkSession, d: str) -> DataFrame:
    found = roles.default_roles(_properties(spark, d))
    return found.select(F.col("key").alias("username"), "default_role")


def q38_role(spark: SparkSession, d: str) -> DataFrame:
    resolved = roles.resolve_roles(
        fx.flat_requests(spark, d), roles.default_roles(_properties(spark, d)), S
    )
    return resolved.select("urn", "resolved_role", "role_origin", "resolved_email")


def q39_event_request(spark: SparkSession, d: str) -> DataFrame:
    return _live_decided(spark, d).select("urn", "decision", "events")


def q39_event_unmatched(spark: SparkSession, d: str) -> DataFrame:
    changed = events.changed_urns(events.routed_events(fx.change_events(spark, d)))
    return events.unmatched_urns(changed, fx.flat_requests(spark, d)).select("urn", "events")


def q40_conformance(spark: SparkSession, d: str) -> DataFrame:
    return conformance.violations(
        fx.nested_requests(spark, d), form_source.access_request_specs()
    )


def q40_product_conformance(spark: SparkSession, d: str) -> DataFrame:
    return conformance.violations(
        fx.product_requests(spark, d), form_source.product_request_specs()
    )


def q41_catchup(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).select("seq", "urn", "resolved_role", "decision")


def q41_catchup_latest(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d, LATEST).select("seq", "urn", "resolved_role", "decision")


def q43_last_writer(spark: SparkSession, d: str) -> DataFrame:
    return sequence.last_per_key(approval.to_provision(_decided(spark, d, LATEST)))


def q44_sla_class(spark: SparkSession, d: str) -> DataFrame:
    pending = requests.pending_requests(fx.flat_requests(spark, d))
    return sla.classify(pending, S).select(
        "urn",
        F.coalesce("sla_class", F.lit("in_time")).alias("sla_class"),
        "pending_hours",
        clock.whole_hours(F.col("pending_hours")).alias("printed_hours"),
    )


def q45_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select(
        "urn", "outcome", "partial", "failed_stmt", "errno", "message"
    )


def _arrivals(store: StateStore, run_id: str, arrived: Column) -> DataFrame:
    """What has become of a run's statements, of those that ``arrived``; each comes twice, the
    second time, later, with the opposite result."""
    planned = store.read("statements").filter(F.col("run_id") == run_id)
    told = fx.execute(planned).filter(arrived).withColumn("planned_run", F.col("run_id"))
    at = F.timestamp_millis(F.lit(fx.AS_OF_MS))
    first = told.withColumn("at", at)
    second = told.withColumns({"ok": ~F.col("ok"), "at": at + F.expr("interval 1 hour")})
    return first.unionByName(second).select(*schemas.STATEMENT_OUTCOMES.names)


def q48_later_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Requests after three runs to which the outcomes come in late, in part and repeatedly.

    By the request's number, all outcomes come before the second run, or the first statement's
    only, or none; everything comes (again) before the third one.
    """
    store = state_store(spark, d, "later")
    number = F.substring_index("urn", ":", -1).cast("bigint") % 4
    early = (number % 2 == 0) | ((number == 1) & (F.col("stmt_no") == 1))
    flat, properties = fx.flat_requests(spark, d), _properties(spark, d)
    nothing = spark.createDataFrame([], schemas.STATEMENT_OUTCOMES)
    deferred.run(store, flat, properties, S, "run-1", nothing)
    deferred.run(store, flat, properties, S, "run-2", _arrivals(store, "run-1", early))
    again = _arrivals(store, "run-1", F.lit(True))
    state = deferred.run(store, flat, properties, S, "run-3", again)
    granted = state.journal.filter("op = 'grant' and run_id <> 'import'")
    failed = store.read("provisioning_errors").filter("run_id <> 'import'")
    waiting = store.open_units.read().filter("action = 'grant'")
    rows = (
        granted.select("urn", F.lit("granted").alias("state"), "run_id")
        .unionByName(
            failed.select(
                F.col("action_request_urn").alias("urn"), F.lit("permanent").alias("state"), "run_id"
            )
        )
        .unionByName(
            waiting.select("urn", F.lit("open").alias("state"), F.col("planned_run").alias("run_id"))
        )
    )
    mails = (
        store.read("notifications")
        .filter("type in ('approval', 'failure')")
        .groupBy("urn")
        .agg(F.count("*").alias("mails"))
    )
    return rows.join(mails, "urn", "left").withColumn("mails", F.coalesce("mails", F.lit(0)))


def q49_state_after(spark: SparkSession, d: str) -> DataFrame:
    state = _state(spark, d)
    journal = state.journal.unionByName(_settled(spark, d, state).journal)
    due = expiry.expired(j.current_grants(journal), S)
    done = expiry.results(due, fx.execute(expiry.plan(due, S)), S)
    revoked = expiry.settle(done, S, RUN)
    return _grant_columns(j.current_grants(journal.unionByName(revoked.journal)))


def q52_sla_state(spark: SparkSession, d: str) -> DataFrame:
    sent = fx.sla_notifications(spark, d)
    due = sla.breaches(requests.pending_requests(fx.flat_requests(spark, d)), S)
    records = j.insert_absent(
        sent, j.sla_rows(due, S), ["action_request_urn", "notification_type"]
    )
    return sent.unionByName(records).select(
        "action_request_urn", "notification_type", _ms("sent_at", "sent_ms")
    )


def q53_error_state(spark: SparkSession, d: str) -> DataFrame:
    errors = fx.provisioning_errors(spark, d)
    records = j.insert_absent(errors, _settled(spark, d).errors, ["action_request_urn"])
    return errors.unionByName(records).select(
        "action_request_urn",
        "snowflake_error_code",
        "error_message",
        _ms("failed_at", "failed_ms"),
    )


def q56_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.decision_counts(_decided(spark, d), S)


def q57_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.quarantined(_decided(spark, d))


def _statement_columns(rows: DataFrame) -> DataFrame:
    return rows.select("urn", "stmt_no", "statement")


def q63_grant_plan(spark: SparkSession, d: str) -> DataFrame:
    return _statement_columns(approval.plan(_decided(spark, d), S))


def q63r_grant_reported(spark: SparkSession, d: str) -> DataFrame:
    provisioned = approval.to_provision(_decided(spark, d))
    return _statement_columns(statements.grant_report_rows(provisioned, S))


def q65_revoke_plan(spark: SparkSession, d: str) -> DataFrame:
    due = expiry.expired(_state(spark, d).grants, S)
    return _statement_columns(expiry.plan(due, S))


def q65s_shared_revokes(spark: SparkSession, d: str) -> DataFrame:
    """Revokes that take nothing another active grant of the role needs."""
    due = expiry.expired(_state(spark, d).grants, SHARED)
    done = expiry.results(due, outcomes.all_ok(expiry.plan(due, SHARED)), SHARED)
    planned = _statement_columns(expiry.plan(due, SHARED))
    freed = expiry.settle(done, SHARED, RUN).journal
    return planned.unionByName(
        freed.select("urn", F.lit(0).alias("stmt_no"), F.lit("revoked").alias("statement"))
    )


def q65r_revoke_reported(spark: SparkSession, d: str) -> DataFrame:
    due = expiry.expired(_state(spark, d).grants, S)
    return _statement_columns(statements.revoke_report_rows(due, S))


def q66_role_grant(spark: SparkSession, d: str) -> DataFrame:
    """The form's role granted to the requestor's own default role."""
    found = roles.default_roles(_properties(spark, d))
    user = identity.username(F.col("requestor_urn"))
    named = (
        fx.flat_requests(spark, d).filter("snowflake_role <> ''").withColumn("key", user)
    )
    named = lookup_join(
        named, found, F.col("key"), "default_role", F.col("urn"), S.hot_key_rows
    ).filter("default_role is not null")
    statement = texts.role_grant_statement(F.col("snowflake_role"), F.col("default_role"))
    return named.select("urn", statement.alias("statement"))


def q67_approval_mail(spark: SparkSession, d: str) -> DataFrame:
    granted = _results(spark, d).filter(F.col("outcome") == outcomes.GRANTED)
    return _notice_columns(
        notices.approval(granted, S),
        "resource",
        "database",
        "schema",
        "role",
        "duration",
        "note",
        "statements",
    )


def q68_denial_mail(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth request got its mail in an earlier run."""
    sent = fx.flat_requests(spark, d).filter("seq % 5 = 0")
    sent = sent.select(F.lit("denial").alias("type"), "urn")
    mails = live.denials(_live_decided(spark, d), sent, S)
    return _notice_columns(mails, "resource", "note")


def q68_denial_mail_each(spark: SparkSession, d: str) -> DataFrame:
    """One mail per event, repeats included."""
    each = replace(S, dedup_denials=False)
    sent = spark.createDataFrame([], "type string, urn string")
    mails = live.denials(_live_decided(spark, d), sent, each)
    return mails.groupBy("urn").agg(F.count("*").alias("mails"))


def q69_sla_mail(spark: SparkSession, d: str) -> DataFrame:
    due = sla_plan.due(fx.flat_requests(spark, d), fx.sla_notifications(spark, d), S)
    return _notice_columns(
        notices.sla(due, S), "resource", "hours", "assignees", "link"
    )


def q71_failure_mail(spark: SparkSession, d: str) -> DataFrame:
    mails = _settled(spark, d).notifications.filter("type = 'failure'")
    return _notice_columns(mails, "resource", "database", "schema", "error", "request")


def q72_revocation_mail(spark: SparkSession, d: str) -> DataFrame:
    due = expiry.expired(_state(spark, d).grants, S)
    done = expiry.results(due, fx.execute(expiry.plan(due, S)), S)
    mails = expiry.settle(done, S, RUN).notifications
    return _notice_columns(mails, "database", "schema", "role", "request")


def _journal_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        "op",
        "urn",
        "requestor_email",
        _ms("granted_at", "granted_ms"),
        _ms("expires_at", "expires_ms"),
        _ms("revoked_at", "revoked_ms"),
        "dry_run",
    )


def q73_approval_pass(spark: SparkSession, d: str) -> DataFrame:
    return _journal_columns(_settled(spark, d).journal)


def q74_expiry_pass(spark: SparkSession, d: str) -> DataFrame:
    due = expiry.expired(_state(spark, d).grants, S)
    done = expiry.results(due, fx.execute(expiry.plan(due, S)), S)
    return _journal_columns(expiry.settle(done, S, RUN).journal)


def q75_sla_pass(spark: SparkSession, d: str) -> DataFrame:
    due = sla_plan.due(fx.flat_requests(spark, d), fx.sla_notifications(spark, d), S)
    notified = sla_plan.settle(due, S)
    keyed = notified.records.select(
        F.col("action_request_urn").alias("urn"),
        F.col("notification_type").alias("type"),
        _ms("sent_at", "sent_ms"),
    )
    return notified.notifications.select("type", "urn", "deliverable").join(
        keyed, ["urn", "type"]
    )


def state_store(spark: SparkSession, d: str, name: str) -> StateStore:
    store = StateStore(spark, scratch_path(spark, name)).ensure()
    store.import_state(
        fx.grants(spark, d), fx.sla_notifications(spark, d), fx.provisioning_errors(spark, d)
    )
    return store


def q76_full_pass(spark: SparkSession, d: str) -> DataFrame:
    """Grants after a written run, repeated under its id and followed by a second run."""
    store = state_store(spark, d, "full")
    for run_id in ("run-1", "run-1", "run-2"):
        state = catchup.run(
            store, fx.flat_requests(spark, d), _properties(spark, d), S, run_id, fx.execute
        )
    return _grant_columns(state.grants)


def q76_compacted_pass(spark: SparkSession, d: str) -> DataFrame:
    """The same with the journal folded before each run."""
    store = state_store(spark, d, "compacted")
    for run_id in ("run-1", "run-2"):
        store.compact()
        store.drop_folded()
        state = catchup.run(
            store, fx.flat_requests(spark, d), _properties(spark, d), S, run_id, fx.execute
        )
    return _grant_columns(state.grants)


def q33_switches(spark: SparkSession, d: str) -> DataFrame:
    """What a written run leaves under each switch; a dry run must not execute anything."""

    def refuse(_: DataFrame) -> DataFrame:
        raise AssertionError("a dry run executes nothing")

    cases = {
        "dry_run": (replace(S, dry_run=True), refuse),
        "expiry_off": (replace(S, expiry_enabled=False), fx.execute),
        "mail_off": (replace(S, revocation_notification=False), fx.execute),
    }
    flat, properties = fx.flat_requests(spark, d), _properties(spark, d)
    parts = []
    for name, (settings, execute) in cases.items():
        store = state_store(spark, d, name)
        catchup.run(store, flat, properties, settings, RUN, execute)
        parts.append(_left_by_run(store, name))
        if settings.dry_run:
            # A live run after the dry one does all that it would have done without it.
            catchup.run(store, flat, properties, S, RUN + "-live", fx.execute)
            parts.append(_left_by_run(store, "dry_then_live"))
    return reduce(DataFrame.unionByName, parts)


def _left_by_run(store: StateStore, name: str) -> DataFrame:
    """Counts of the rows in force that the runs of a store left."""
    changes = store.state().journal.filter("run_id <> 'import'").select("op")
    mails = store.read("notifications").filter("type = 'revocation' and not dry_run")
    warned = store.read("sla_notifications").filter("run_id <> 'import' and not dry_run")
    rows = changes.unionByName(mails.select(F.lit("mail").alias("op"))).unionByName(
        warned.select(F.lit("sla").alias("op"))
    )
    return rows.agg(
        F.count_if(F.col("op") == j.GRANT).alias("granted"),
        F.count_if(F.col("op") == j.REVOKE).alias("revoked"),
        F.count_if(F.col("op") == "mail").alias("mails"),
        F.count_if(F.col("op") == "sla").alias("sla"),
    ).select(F.lit(name).alias("switch"), "*")


def _stream(spark: SparkSession, d: str, again: int) -> DataFrame:
    store = state_store(spark, d, "live")
    files = f"{store.root}/events"
    for _ in range(again):
        fx.change_events(spark, d).repartitionByRange(4, "event_id").write.mode(
            "append"
        ).parquet(files)
    current = f"{store.root}/current"
    request_source.write_current_requests(fx.nested_requests(spark, d), current, 8)
    query = live_stream.start(
        stream_events(spark, files, max_files_per_trigger=2),
        store,
        lambda changed: request_source.bucket_lookup(
            request_source.read_current_requests(spark, current), changed, 8
        ),
        _properties(spark, d),
        S,
        f"{store.root}/checkpoint",
        "live",
        outcomes.all_ok,
    )
    query.awaitTermination()
    granted = store.state().journal.filter("run_id <> 'import'").select("urn")
    mailed = store.read("notifications").filter("type = 'denial'").select("urn")
    return granted.withColumn("action", F.lit("provision")).unionByName(
        mailed.withColumn("action", F.lit("deny"))
    )


def q77_stream_live(spark: SparkSession, d: str) -> DataFrame:
    """Requests acted on by a stream of event files: the live decisions of one batch."""
    return _stream(spark, d, 1)


def q79_stream_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """The same when every event arrives again in later batches, with its old time and id."""
    return _stream(spark, d, 2)


def q81_event_fates(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of all events over three runs with a memory of two days: most events first, all of
    them with every third a second time, and all of them again. The second run is repeated under
    its id; the clock stands within the range of the events."""
    settings = replace(S, as_of_ms=1_706_500_000_000)
    found = events.routed_events(fx.change_events(spark, d))
    third = found.filter("event_id % 3 = 0")
    runs = [found.filter("event_id % 4 <> 0"), found.unionByName(third), found]
    deliveries = Deliveries(state_store(spark, d, "fates"), Memory(keep_hours=48))
    for number in (0, 1, 1, 2):
        deliveries.receive(runs[number], f"run-{number}", settings)
    rows = deliveries.store.spark.read.parquet(deliveries.store.path("delivery_counts"))
    return rows.select("run_id", *redelivery.COUNTS)


def q65p_residual_privileges(spark: SparkSession, d: str) -> DataFrame:
    revoked = _state(spark, d).grants.filter("revoked_at is not null")
    return privileges.residual_privileges(revoked, S)


def all_queries() -> dict[str, Query]:
    found = {
        name: value
        for name, value in globals().items()
        if name[0] == "q" and name[1:3].isdigit() and callable(value)
    }
    return dict(sorted(found.items()))
