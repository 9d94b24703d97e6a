import json
from dataclasses import replace

from pyspark.sql import functions as F

from grantline.operators import requests
from grantline.sources import requests as source
from tests.builders import DAY, flat, flat_row, rows_of
from tests.conftest import AS_OF_MS
from tests.test_forms import nested


def urns(frame):
    return sorted(r.urn for r in frame.select("urn").collect())


def test_approved_scan(spark, settings):
    frame = flat(
        spark,
        flat_row("in"),
        flat_row("edge", created_ms=AS_OF_MS - 90 * DAY),
        flat_row("old", created_ms=AS_OF_MS - 90 * DAY - 1),
        flat_row("denied", result="REJECTED"),
        flat_row("open", status="PENDING", result=None),
        flat_row("no result", result=None),
        flat_row("other", request_type="TAG_ASSOCIATION"),
    )
    assert urns(requests.approved_requests(frame, settings)) == ["edge", "in"]
    wider = replace(settings, lookback_days=91)
    assert urns(requests.approved_requests(frame, wider)) == ["edge", "in", "old"]


def test_pending_scan_reads_every_row(spark):
    rows = [flat_row(f"p{i:03d}", i, status="PENDING", result=None) for i in range(250)]
    found = requests.pending_requests(flat(spark, flat_row("done"), *rows))
    assert len(urns(found)) == 250


def test_lookup(spark):
    frame = flat(spark, flat_row("a"), flat_row("b"))
    wanted = spark.createDataFrame([("b",), ("c",)], "urn string")
    assert urns(requests.lookup(frame, wanted)) == ["b"]


def test_first_listed_copy_counts(spark):
    frame = flat(
        spark, flat_row("a", 9, note="late"), flat_row("a", 2, note="early"), flat_row("b", 3)
    )
    found = requests.first_per_urn(requests.slim(frame))
    assert rows_of(found, "urn", "seq", "note") == [("a", 2, "early"), ("b", 3, "Looks good")]


GOOD = {
    "urn": "u",
    "type": "WORKFLOW_FORM_REQUEST",
    "status": "COMPLETED",
    "created": {"time": 1700000000000, "actor": {"urn": "urn:li:corpuser:a"}},
    "params": {
        "workflowFormRequest": {
            "fields": [
                {"id": "snowflake_role", "values": [{"stringValue": "R"}]},
                {"id": "access_duration_days", "values": [{"numberValue": 30}]},
                {"id": "empty"},
            ],
            "access": None,
        }
    },
}


def check(spark, *documents):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    raw = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    return source.checked(raw).orderBy("seq")


def changed(path, value):
    document = json.loads(json.dumps(GOOD))
    *outer, last = path.split(".")
    inner = document
    for key in outer:
        inner = inner[int(key)] if isinstance(inner, list) else inner[key]
    if value is KeyError:
        del inner[last]
    else:
        inner[int(last) if isinstance(inner, list) else last] = value
    return document


def test_good_documents_are_typed(spark):
    row = check(spark, GOOD).first()
    assert row.reason is None and row.created.time == 1700000000000
    assert row.assignedUsers == [] and row.params.workflowFormRequest.access is None
    fields = row.params.workflowFormRequest.fields
    assert [f.id for f in fields] == ["snowflake_role", "access_duration_days", "empty"]
    assert fields[1]["values"][0].numberValue == 30.0


def test_numbers_in_text_are_taken(spark):
    form = "params.workflowFormRequest.fields.1.values.0.numberValue"
    rows = check(
        spark, changed("created.time", "1700000000000"), changed("created.time", 17.0),
        changed(form, "30"),
    ).collect()
    assert [r.reason for r in rows] == [None, None, None]
    assert [r.created.time for r in rows[:2]] == [1700000000000, 17]
    assert rows[2].params.workflowFormRequest.fields[1]["values"][0].numberValue == 30.0


def test_each_fault_has_its_reason(spark):
    fields = "params.workflowFormRequest.fields"
    cases = [
        ("{bad", "malformed_json"),
        ("", "malformed_json"),
        ("[1]", "not_an_object"),
        ("null", "not_an_object"),
        (changed("urn", KeyError), "missing:urn"),
        (changed("urn", None), "missing:urn"),
        (changed("urn", 5), "bad_type:urn"),
        (changed("type", KeyError), "missing:type"),
        (changed("status", True), "bad_type:status"),
        (changed("created", KeyError), "missing:created.time"),
        (changed("created.time", None), "missing:created.time"),
        (changed("created.time", 1.5), "bad_type:created.time"),
        (changed("created.time", "soon"), "bad_type:created.time"),
        (changed("created.time", "1e400"), "bad_type:created.time"),
        ({**GOOD, "result": 3}, "bad_type:result"),
        ({**GOOD, "entity": {}}, "bad_type:entity"),
        ({**GOOD, "entity": []}, "bad_type:structure"),
        (changed("created.actor", {"urn": None}), "bad_type:created.actor"),
        ({**GOOD, "assignedUsers": None}, "bad_type:assignedUsers"),
        ({**GOOD, "assignedUsers": ["a", 1]}, "bad_type:assignedUsers"),
        ({**GOOD, "assignedGroups": "g"}, "bad_type:assignedGroups"),
        ({**GOOD, "dueDate": "x"}, "bad_type:dueDate"),
        (changed(fields, None), "bad_type:fields"),
        (changed(f"{fields}.0.id", 7), "bad_type:fields"),
        (changed(f"{fields}.0.values", None), "bad_type:fields"),
        (changed(f"{fields}.0.values.0.stringValue", 7), "bad_type:fields"),
        (changed(f"{fields}.1.values.0.numberValue", "many"), "bad_type:fields"),
        (changed("params", None), None),
        ({**GOOD, "extra": 1, "entity": None, "result": None}, None),
    ]
    rows = check(spark, *[document for document, _ in cases]).collect()
    assert [r.reason for r in rows] == [reason for _, reason in cases]


def test_a_bad_row_does_not_take_others_along(spark):
    rows = check(spark, "{bad", GOOD, changed("urn", 5))
    assert [r.urn for r in source.good_rows(rows).collect()] == ["u"]
    assert rows_of(source.bad_rows(rows), "urn", "reason") == [
        ("5", "bad_type:urn"),
        (None, "malformed_json"),
    ]


def test_current_requests_are_found_by_bucket(spark, tmp_path):
    path = str(tmp_path / "current")
    frame = nested(spark).crossJoin(spark.range(200)).withColumn(
        "urn", F.concat(F.lit("urn:li:actionRequest:"), F.col("id").cast("string"))
    ).drop("id")
    source.write_current_requests(frame, path, 4)
    current = source.read_current_requests(spark, path)
    assert current.count() == 200
    found = source.point_lookup(current, "urn:li:actionRequest:77", 4)
    assert [r.urn for r in found.collect()] == ["urn:li:actionRequest:77"]
    assert source.point_lookup(current, "none", 4).count() == 0
    wanted = spark.createDataFrame([("urn:li:actionRequest:3",), ("none",)], "urn string")
    assert source.bucket_lookup(current, wanted, 4).count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(urn_bucket" in plan
