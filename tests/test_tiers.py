"""Key sets in tiers against one plain table, and what a reader opens."""

import random

import pytest
from pyspark.sql import types as T

from grantline.state import tiers
from tests.builders import rows_of

SCHEMA = T.StructType(
    [
        T.StructField("urn", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("dry_run", T.BooleanType()),
    ]
)


@pytest.fixture
def key_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tiers, "FAN", 3)
    return tiers.KeySet(spark, str(tmp_path / "keys"), SCHEMA, ["urn"])


def add(key_set, run, *urns, dry=False, step="s"):
    rows = [(u, f"{run}:{u}", dry) for u in urns]
    key_set.add(key_set.spark.createDataFrame(rows, SCHEMA), run, step)


def test_first_entries_stay_and_parts_stay_few(key_set):
    source = random.Random(2)
    first, most = {}, 0
    for n in range(14):
        run = f"r{n:02d}"
        urns = sorted({f"u{source.randint(0, 12)}" for _ in range(3)})
        key_set.fold(run)
        add(key_set, run, *urns)
        for u in urns:
            first.setdefault(u, f"{run}:{u}")
        most = max(most, len(key_set.manifest.read()["parts"]))
    # Three parts a tier at most, but for the two newest runs and the one that writes.
    assert most <= 9
    found = {}
    for u, detail in rows_of(key_set.read(), "urn", "detail"):
        found[u] = min(detail, found.get(u, detail))
    assert found == first
    listed = key_set.files.names(f"{key_set.folder}/parts")
    assert len(listed) <= most + 4
    assert len(key_set.files.names(f"{key_set.folder}/manifest")) <= 4


def test_a_run_replaces_its_own_rows_and_does_not_see_them(key_set):
    add(key_set, "r1", "a", "b")
    add(key_set, "r2", "c")
    add(key_set, "r2", "d")
    assert rows_of(key_set.read(), "urn", "run_id") == [("a", "r1"), ("b", "r1"), ("d", "r2")]
    assert rows_of(key_set.read("r2"), "urn") == [("a",), ("b",)]


def test_newest_runs_are_not_folded_and_folded_ones_not_repeated(key_set):
    for n in range(5):
        add(key_set, f"r{n}", f"u{n}")
    assert key_set.fold()
    tiers_ = [p["tier"] for p in key_set.manifest.read()["parts"]]
    assert tiers_ == [1, 0, 0]
    add(key_set, "r4", "other")
    assert rows_of(key_set.read(), "urn") == [("other",), ("u0",), ("u1",), ("u2",), ("u3",)]
    with pytest.raises(ValueError, match="folded"):
        add(key_set, "r2", "again")


def test_dry_rows_are_folded_apart(key_set):
    add(key_set, "r0", "a", dry=True)
    for n in range(1, 5):
        add(key_set, f"r{n}", "a")
    key_set.fold()
    found = rows_of(key_set.read().where("run_id < 'r3'"), "detail", "dry_run")
    assert found == [("r0:a", True), ("r1:a", False)]


def test_a_batch_of_unknown_keys_opens_no_folded_part(spark, key_set):
    for n in range(5):
        add(key_set, f"r{n}", *[f"u{n}-{i}" for i in range(40)])
    key_set.fold()
    add(key_set, "r5", "fresh")
    (folded,) = [p for p in key_set.manifest.read()["parts"] if "blocks" in p]
    assert folded["blocks"] == 6

    def opened(*urns):
        batch = spark.createDataFrame([(u,) for u in urns], "urn string")
        found = key_set.matching(batch, "urn")
        return rows_of(found, "urn"), any(folded["path"] in f for f in found.inputFiles())

    assert opened("none", "nothing", "zero") == ([], False)
    assert opened("u1-7", "fresh", "none") == ([("fresh",), ("u1-7",)], True)


def test_sketches_lose_no_key_and_few_others_pass(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as urn")
    blocks = 3000 // tiers.KEYS_A_BLOCK
    sketched = tiers.sketch(keys, "urn", blocks)
    assert tiers.maybe_in(keys, "urn", sketched, blocks).count() == 3000
    others = spark.range(3000).selectExpr("concat('x', id) as urn")
    assert tiers.maybe_in(others, "urn", sketched, blocks).count() < 60


def test_carried_rows_start_from_the_run_before(spark, tmp_path):
    schema = T.StructType([T.StructField("x", T.LongType())])
    carried = tiers.Carried(spark, str(tmp_path / "open"), schema)

    def frame(*values):
        return spark.createDataFrame([(v,) for v in values], schema)

    assert rows_of(carried.read("r1"), "x") == []
    carried.write(frame(1, 2), "r1")
    carried.write(frame(2, 3), "r2")
    carried.write(frame(3, 4), "r2")
    assert rows_of(carried.read("r2"), "x") == [(1,), (2,)]
    assert rows_of(carried.read("r3"), "x") == [(3,), (4,)]
    carried.write(frame(5), "r3")
    assert len(carried.manifest.read()["parts"]) == 2
    assert rows_of(carried.read("r3"), "x") == [(3,), (4,)]
