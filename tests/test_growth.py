"""What grows with the input is neither sorted by a fixed number of tasks, nor broadcast, nor shuffled twice."""

import glob

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import queries
from grantline import schemas
from grantline.operators import guards, ledger, requests
from grantline.operators.skew import lookup_join
from grantline.sources import requests as source


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def nested(spark, urns):
    rows = [{"seq": i, "urn": urn, "type": "T", "status": "S"} for i, urn in enumerate(urns)]
    return spark.createDataFrame(rows, schemas.ACTION_REQUESTS)


def test_the_files_of_a_listing_follow_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LISTING_ROWS", 50)
    lines = spark.range(1000).select(
        (F.lit(999) - F.col("id")).alias("seq"), (F.lit(999) - F.col("id")).cast("string").alias("value")
    )
    path = str(tmp_path / "listing")
    queries._write_listing(lines, path, 1000)
    assert len(glob.glob(f"{path}/part-*")) == 20
    read = source.read_json_lines(spark, path)
    assert read.filter("value <> cast(seq as string)").count() == 0 and read.count() == 1000


def test_state_tables_and_users_are_not_broadcast(spark):
    rows = spark.createDataFrame([("u1", "a", "warning")], "urn string, user string, sla_class string")
    urns = spark.createDataFrame([("u1",), (None,)], "urn string")
    errors = urns.withColumnRenamed("urn", "action_request_urn")
    sent = errors.withColumn("notification_type", F.lit("warning"))
    grants = spark.createDataFrame(
        [("u2", None)], "latest_action_request_urn string, revoked_at timestamp"
    )
    found = [
        guards.flag(rows, urns, "known"),
        guards.not_granted_before(rows, urns),
        guards.not_failed(rows, errors),
        guards.not_notified(rows, sent),
        guards.not_provisioned(rows, grants),
    ]
    assert [f.count() for f in found] == [1, 0, 0, 0, 1]
    assert not any("Broadcast" in plan_of(f) for f in found)


def test_only_hot_keys_of_a_lookup_are_broadcast(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "user string, n int")
    right = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, role string")
    found = lookup_join(left, right, F.col("user"), "role", F.col("n"), 2)
    assert {(r["n"], r["role"]) for r in found.collect()} == {(1, "A"), (2, "A"), (3, "B"), (4, None)}
    assert plan_of(found).count("BroadcastHashJoin") == 1


def test_customers_are_not_broadcast(spark, tmp_path):
    for table in ("orders", "customer", "nation"):
        columns = fx.SOURCES[table]
        spark.createDataFrame([], columns).write.parquet(str(tmp_path / f"{table}.parquet"))
    plan = plan_of(fx.view(spark, str(tmp_path), "requests"))
    assert "c_custkey" in plan and "SortMergeJoin" in plan


def test_whole_requests_are_shuffled_once(spark):
    rows = nested(spark, ["a", "b", "a", None])
    placed = rows.withColumn(source.BUCKET, source.bucket_of(F.col("urn"), 4))
    first = requests.first_per_urn(placed.repartitionByRange(source.BUCKET, "urn"), source.BUCKET)
    assert plan_of(first.sortWithinPartitions(source.BUCKET, "urn")).count("Exchange") == 1
    assert sorted((str(r["urn"]), r["seq"]) for r in first.collect()) == [("None", 3), ("a", 0), ("b", 1)]


def test_many_copies_collapse_before_they_are_laid_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "MANY_COPIES", 3)
    rows = nested(spark, ["a", "b", "a", None, "a", "b", None, None, ""])
    few = source._few_copies(rows)
    assert sorted((str(r["urn"]), r["seq"]) for r in few.collect()) == [
        ("", 8), ("None", 3), ("a", 0), ("b", 1), ("b", 5),
    ]
    source.write_current_requests(rows, str(tmp_path / "current"), 4)
    kept = source.read_current_requests(spark, str(tmp_path / "current"))
    assert sorted((str(r["urn"]), r["seq"]) for r in kept.collect()) == [
        ("", 8), ("None", 3), ("a", 0), ("b", 1),
    ]


def test_open_units_are_not_broadcast(spark, tmp_path, settings):
    for name, schema in (("units", schemas.OPEN_UNITS), ("told", schemas.STATEMENT_OUTCOMES)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    units, told = (spark.read.parquet(str(tmp_path / n)) for n in ("units", "told"))
    found = [ledger.progress(units, told, settings), ledger.not_open(units, told)]
    assert all("SortMergeJoin" in plan_of(f) and "Broadcast" not in plan_of(f) for f in found)
