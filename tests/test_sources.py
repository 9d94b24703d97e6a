import random

import pytest
from pyspark.sql import functions as F

from grantline import schemas
from grantline.checkpoints import scratch_path, shared_folder, written
from grantline.settings import Settings
from grantline.sources.events import read_events
from grantline.sources.properties import read_user_properties
from grantline.operators.requests import flatten
from grantline.plans import intake
from grantline.sources import requests
from grantline.sources.requests import (
    bad_rows,
    checked,
    good_rows,
    read_json_lines,
    read_requests,
)
from grantline.state.store import StateStore
from tests.builders import properties, rows_of
from tests.conftest import AS_OF_MS
from tests.test_forms import nested
from tests.test_streaming import event_rows


def test_requests_from_files(spark, tmp_path):
    for source in ("parquet", "json"):
        path = str(tmp_path / source)
        nested(spark).write.format(source).save(path)
        frame = read_requests(spark, path, source)
        assert frame.schema.names == schemas.ACTION_REQUESTS.names
        assert frame.collect() == nested(spark).collect()


def test_json_lines_from_files(spark, tmp_path):
    (tmp_path / "page.json").write_text(
        '{"urn":"a","type":"T","status":"PENDING","created":{"time":1}}\n{"urn":"b"}\n'
    )
    rows = checked(read_json_lines(spark, str(tmp_path / "page.json")))
    assert rows_of(rows, "urn", "reason") == [("a", None), (None, "missing:type")]
    assert good_rows(rows).count() == 1


def test_from_json_lines_to_decisions(spark, settings, tmp_path):
    """A listing as text goes through check, flattening and decision without help."""
    page = nested(spark).drop("seq").toJSON().collect()
    (tmp_path / "page.json").write_text("\n".join([*page, "{broken"]) + "\n")
    rows = checked(read_json_lines(spark, str(tmp_path / "page.json")))
    flat = flatten(good_rows(rows), settings)
    assert flat.count() == len(page) and flat.filter("seq is null").count() == 0
    assert rows_of(bad_rows(rows), "reason") == [("malformed_json",)]


def test_number_texts_and_missing_places(spark):
    def document(number):
        form = '{"fields":[{"id":"x","values":[{"numberValue":%s}]}]}' % number
        head = '{"urn":"a","type":"T","status":"S","created":{"time":1},'
        return head + '"params":{"workflowFormRequest":%s}}' % form

    numbers = ['"30d"', '"30"', "true", "2.5", '"1e3"', '"f"']
    texts = [(i, document(n)) for i, n in enumerate(numbers)] + [(None, document("1"))]
    rows = checked(spark.createDataFrame(texts, "seq long, value string"))
    value = F.get(F.get("params.workflowFormRequest.fields", F.lit(0))["values"], F.lit(0))
    found = rows.select("seq", "reason", value["numberValue"].alias("n"))
    assert rows_of(found, "seq", "reason", "n") == [
        (0, "bad_type:fields", None),
        (1, None, 30.0),
        (2, None, 1.0),
        (3, None, 2.5),
        (4, None, 1000.0),
        (5, "bad_type:fields", None),
        (None, "missing:seq", None),
    ]


def test_events_and_properties_from_files(spark, tmp_path):
    event_rows(spark, "u").write.parquet(str(tmp_path / "events"))
    assert rows_of(read_events(spark, str(tmp_path / "events")), "entity_urn") == [("u",)]
    properties(spark, ("a", "DEFAULT_ROLE", "R")).write.parquet(str(tmp_path / "users"))
    found = read_user_properties(spark, str(tmp_path / "users"))
    assert rows_of(found, "username", "value", "ordinal") == [("a", "R", None)]


def test_written_tables_go_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    frame = written(spark.range(5), "numbers")
    assert frame.count() == 5 and folder in frame.inputFiles()[0]


def test_settings_are_checked():
    with pytest.raises(ValueError, match="guard"):
        Settings(as_of_ms=AS_OF_MS, guard="none")
    with pytest.raises(ValueError, match="username_format"):
        Settings(as_of_ms=AS_OF_MS, username_format="x")


def test_lines_are_numbered_in_the_order_of_paths(spark, tmp_path):
    """Files of rising and of falling size, empty ones, and files that are split."""
    rng = random.Random(3)
    expected = []
    for name, lines in (("a", 3), ("b", 400), ("c", 0), ("d", 5000), ("e", 1), ("f", 90)):
        made = [f"{name}{i}-" + "x" * rng.randint(0, 60) for i in range(lines)]
        (tmp_path / f"{name}.json").write_text("".join(f"{line}\n" for line in made))
        expected += made
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = requests.read_json_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in sorted(rows, key=lambda r: r.seq)] == expected
    assert sorted(r.seq for r in rows) == list(range(len(expected)))


def test_an_empty_listing(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert requests.read_json_lines(spark, str(tmp_path)).collect() == []


def test_rejected_lines_are_on_record_once(spark, settings, tmp_path):
    store = StateStore(spark, str(tmp_path / "state")).ensure()
    listing = tmp_path / "listing"
    listing.mkdir()
    (listing / "p1.json").write_text('{"urn":"u1"}\n{"broken\n{"urn":"u2","type":"T"}\n{"broken 2\n')
    for run in ("r1", "r2"):
        assert intake.json_listing(store, str(listing), settings, run).count() == 0
    found = store.read("quarantine").collect()
    assert sorted((r.urn or "", r.reason, r.run_id) for r in found) == [
        ("", "malformed_json", "r1"), ("", "malformed_json", "r1"),
        ("u1", "missing:type", "r1"), ("u2", "missing:status", "r1"),
    ]
