from dataclasses import replace

from pyspark.sql import functions as F

from grantline.operators import roles
from grantline.operators.skew import hot_keys, lookup_join
from tests.builders import flat, flat_row, properties, rows_of


def test_default_roles(spark):
    frame = properties(
        spark,
        ("alice", "DEFAULT_ROLE", " ANALYST \n"),
        ("alice", "DEFAULT_WAREHOUSE", "WH"),
        ("bob", "DEFAULT_ROLE", ""),
        ("carol", "DEFAULT_ROLE", None),
        ("dave", "DEFAULT_ROLE", "   "),
    )
    assert rows_of(roles.default_roles(frame), "key", "default_role") == [("alice", "ANALYST")]


def test_first_non_empty_property_row_counts(spark):
    frame = spark.createDataFrame(
        [
            ("a", "DEFAULT_ROLE", "", 1),
            ("a", "DEFAULT_ROLE", "Z", 2),
            ("a", "DEFAULT_ROLE", "B", 3),
            ("b", "DEFAULT_ROLE", "  ", 1),
            ("b", "DEFAULT_ROLE", "X", 2),
        ],
        "username string, property string, value string, ordinal int",
    )
    assert rows_of(roles.default_roles(frame), "key", "default_role") == [("a", "Z")]


def resolve(spark, settings, *rows, props=()):
    known = roles.default_roles(properties(spark, *props, ("nobody", "X", "Y")))
    return rows_of(
        roles.resolve_roles(flat(spark, *rows), known, settings),
        "urn", "resolved_role", "role_origin", "resolved_email",
    )


def test_resolution_order(spark, settings):
    props = [
        ("alice", "DEFAULT_ROLE", "HOME"),
        ("john@x.com", "DEFAULT_ROLE", "JOHNS"),
    ]
    found = resolve(
        spark,
        settings,
        flat_row("form"),
        flat_row("null", snowflake_role=None),
        flat_row("empty", snowflake_role="", requestor_email=""),
        flat_row("mail", snowflake_role=None, requestor_urn="urn:li:corpuser:john@x.com",
                 requestor_email=None),
        flat_row("unknown", snowflake_role=None, requestor_urn="urn:li:corpuser:zoe"),
        flat_row("group", snowflake_role=None, requestor_urn="urn:li:corpGroup:alice"),
        flat_row("none", snowflake_role=None, requestor_urn=None, requestor_email=None),
        props=props,
    )
    assert found == [
        ("empty", "HOME", "default_role", None),
        ("form", "ANALYST_ROLE", "form", "alice@example.com"),
        ("group", None, None, "alice@example.com"),
        ("mail", "JOHNS", "default_role", "john@x.com"),
        ("none", None, None, None),
        ("null", "HOME", "default_role", "alice@example.com"),
        ("unknown", None, None, "alice@example.com"),
    ]


def test_local_part_format(spark, settings):
    local = replace(settings, username_format="email_local_part")
    found = resolve(
        spark,
        local,
        flat_row("a", snowflake_role=None, requestor_urn="urn:li:corpuser:john@x.com"),
        props=[("john", "DEFAULT_ROLE", "JOHNS")],
    )
    assert found[0][1] == "JOHNS"


def test_hot_keys_are_bounded_by_their_size(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") < 700, F.lit("hot"))
        .when(F.col("id") < 900, F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
        .alias("key")
    )
    assert [r.key for r in hot_keys(frame, 100).collect()] == ["hot"]


def test_lookup_join_gives_the_same_with_and_without_hot_keys(spark):
    left = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 0, F.lit("hot but unknown"))
        .when(F.col("id") % 11 != 0, F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("k"),
    )
    right = spark.createDataFrame(
        [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 50, 2)], "key string, value string"
    )
    plain = left.join(right, F.col("k") == F.col("key"), "left").select("id", "k", "value")
    expected = rows_of(plain, "id", "k", "value")
    for size in (1, 100, 10**9):
        found = lookup_join(left, right, F.col("k"), "value", F.col("id"), size)
        assert rows_of(found, "id", "k", "value") == expected


def test_hot_rows_spread_over_the_partitions(spark):
    """With broadcasting off, the rows of a hot key do not meet in one shuffle partition."""
    left = spark.range(4000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", "H")], "key string, value string")
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in keep}
    for name, value in keep.items():
        spark.conf.set(name, value)
    try:
        found = lookup_join(left, right, F.col("k"), "value", F.col("id"), 1000)
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1500
