from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grantline.operators import notices, requests, sla
from grantline.plans import sla as plan
from tests.builders import HOUR, empty, flat, flat_row, grants, no_sla, rows_of
from tests.conftest import AS_OF_MS


def pending(spark, *rows):
    return flat(
        spark,
        *[
            flat_row(urn, seq, status="PENDING", result=None, created_ms=created, **more)
            for seq, (urn, created, more) in enumerate(rows)
        ],
    )


def ago(hours):
    return AS_OF_MS - int(hours * HOUR)


def test_bounds_are_inclusive_and_escalation_wins(spark, settings):
    frame = pending(
        spark,
        ("w0", ago(24) + 1, {}),
        ("w1", ago(24), {}),
        ("w2", ago(72) + 1, {}),
        ("e1", ago(72), {}),
        ("e2", ago(80), {}),
        ("zero", 0, {}),
        ("null", None, {}),
    )
    found = sla.classify(requests.pending_requests(frame), settings)
    assert rows_of(found, "urn", "sla_class") == [
        ("e1", "escalation"),
        ("e2", "escalation"),
        ("w0", None),
        ("w1", "warning"),
        ("w2", "warning"),
    ]


def test_a_breach_is_notified_once(spark, settings):
    frame = pending(spark, ("a", ago(30), {}), ("b", ago(30), {}), ("c", ago(80), {}))
    sent = spark.createDataFrame(
        [("a", "warning"), ("c", "warning")], "action_request_urn string, notification_type string"
    )
    assert rows_of(plan.due(frame, sent, settings), "urn", "sla_class") == [
        ("b", "warning"),
        ("c", "escalation"),
    ]


def test_sla_mails(spark, settings):
    leads = replace(settings, escalation_recipients=("lead@example.com",))
    frame = pending(
        spark,
        ("w", ago(26.5), {}),
        ("e", ago(80), {"resource": None}),
        ("n", ago(90), {"requestor_email": None}),
    )
    done = plan.settle(plan.due(frame, no_sla(spark), leads), leads)
    mails = {r.urn: r for r in done.notifications.collect()}
    assert mails["w"].subject == "⚠️ Action required: access request pending for 26h"
    assert mails["w"].to == ["alice@example.com"] and mails["w"].cc == []
    assert mails["w"].payload["resource"] == "urn:li:dataset:orders"
    assert mails["e"].subject == (
        "🚨 Escalation: access request pending 80h — immediate action required"
    )
    assert mails["e"].cc == ["lead@example.com"] and mails["e"].payload["resource"] == "e"
    assert mails["e"].payload["assignees"] == "alice@example.com"
    assert mails["n"].to == [] and not mails["n"].deliverable
    assert mails["n"].payload["assignees"] == "—"
    # A breach nobody can be told about is on record all the same.
    assert [r[0] for r in rows_of(done.records, "action_request_urn")] == ["e", "n", "w"]


def granted(spark, **values):
    return flat(spark, flat_row("u", **values)).withColumn(
        "resolved_role", F.coalesce("snowflake_role", F.lit("HOME"))
    )


def test_approval_mail_shows_form_values(spark, settings):
    mail = notices.approval(granted(spark), settings).first()
    assert mail.subject == "✅ Your data catalog access request has been approved"
    assert mail.to == ["alice@example.com"] and mail.deliverable
    assert mail.payload["duration"] == "30 days" and mail.payload["role"] == "ANALYST_ROLE"
    assert mail.payload["statements"].splitlines()[2].startswith("GRANT SELECT ON ALL/FUTURE")


def test_approval_mail_fallbacks(spark, settings):
    bare = granted(
        spark, snowflake_role=None, snowflake_schema="", duration_raw="0", note=None,
        resource=None, requestor_email="", requestor_urn="urn:li:corpuser:a@b.c",
    )
    mail = notices.approval(bare, settings).first()
    assert mail.to == [] and not mail.deliverable
    assert mail.payload == {
        "resource": "—",
        "database": "PROD",
        "schema": "(all schemas)",
        "role": "—",
        "duration": "Indefinite",
        "note": "",
        "statements": mail.payload["statements"],
    }
    assert "TO ROLE HOME" in mail.payload["statements"]


def test_names_of_the_systems_are_settings(spark, settings):
    named = replace(settings, catalog_name="Atlas", target_name="Lake")
    assert notices.approval(granted(spark), named).first().subject == (
        "✅ Your Atlas access request has been approved"
    )


@pytest.mark.parametrize(("note", "shown"), [("No", "No"), ("", "No reason provided."), (None, "No reason provided.")])
def test_denial_mail(spark, settings, note, shown):
    mail = notices.denial(flat(spark, flat_row("u", note=note)), settings).first()
    assert mail.subject == "❌ Your data catalog access request has been denied"
    assert mail.payload == {"resource": "urn:li:dataset:orders", "note": shown}


def test_failure_mail(spark, settings):
    failed = granted(spark).withColumn("message", F.lit("Role X does not exist"))
    mail = notices.failure(failed, settings).first()
    assert mail.payload["error"] == "Role X does not exist" and mail.payload["request"] == "u"


def test_revocation_mail(spark, settings):
    frame = grants(
        spark,
        ("ANALYST", "PROD", "", "u", "bob@example.com", AS_OF_MS, AS_OF_MS, None),
        ("ANALYST", "PROD", "S", "v", None, AS_OF_MS, AS_OF_MS, None),
    )
    mails = {r.urn: r for r in notices.revocation(frame, settings).collect()}
    assert mails["u"].payload["schema"] == "(all schemas)" and mails["u"].deliverable
    assert mails["v"].payload["schema"] == "S" and not mails["v"].deliverable
    assert mails["u"].subject == "🔒 Your warehouse access has expired and been revoked"


def test_printed_hours_in_mails(spark, settings):
    hours = [24.5, 25.5, 26.5, 27.5]
    frame = pending(spark, *[(f"u{h}", ago(h), {}) for h in hours])
    done = plan.settle(plan.due(frame, empty(spark, no_sla(spark).schema), settings), settings)
    shown = {r.urn: r.payload["hours"] for r in done.notifications.collect()}
    assert shown == {f"u{h}": f"{h:.0f}" for h in hours}
