from pyspark.sql import functions as F

from grantline.operators import outcomes
from tests.builders import rows_of

SCHEMA = "urn string, stmt_no int, ok boolean, errno int, message string"


def outcome_rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_roll_up(spark):
    frame = outcome_rows(
        spark,
        ("good", 1, True, None, None),
        ("good", 2, True, None, None),
        ("late", 1, True, None, None),
        ("late", 3, False, 604, "second failure"),
        ("late", 2, False, 2003, "no such role"),
        ("first", 1, False, 90001, "timeout"),
        ("legacy", 1, False, 2001, "gone"),
        ("bare", 1, False, None, None),
    )
    found = outcomes.roll_up(frame)
    assert rows_of(found, "urn", "outcome", "partial", "failed_stmt", "errno", "message") == [
        ("bare", "transient", False, 1, None, None),
        ("first", "transient", False, 1, 90001, "timeout"),
        ("good", "granted", False, None, None, None),
        ("late", "permanent", True, 2, 2003, "no such role"),
        ("legacy", "permanent", False, 1, 2001, "gone"),
    ]


def test_a_run_cut_short_is_not_a_grant(spark):
    planned = spark.createDataFrame([("all",), ("some",), ("none",)], "urn string")
    frame = outcome_rows(
        spark,
        ("all", 1, True, None, None),
        ("all", 2, True, None, None),
        ("some", 1, True, None, None),
        ("some", 1, True, None, None),
    )
    found = outcomes.with_outcomes(planned, frame, F.lit(2))
    assert rows_of(found, "urn", "outcome") == [
        ("all", "granted"),
        ("none", "transient"),
        ("some", "transient"),
    ]
