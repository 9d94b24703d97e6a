import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from grantline.functions import forms
from grantline.operators import requests
from grantline.schemas import ACTION_REQUESTS, FORM_FIELD
from grantline.settings import FieldIds, Settings
from tests.conftest import AS_OF_MS


def python_text(n):
    return str(int(n)) if n == int(n) else str(n)


def texts(spark, numbers):
    frame = spark.createDataFrame([(i, float(n)) for i, n in enumerate(numbers)], "i int, n double")
    rows = frame.select("i", forms.number_text(F.col("n")).alias("t")).collect()
    return [r.t for r in sorted(rows)]


def test_whole_numbers_have_no_decimals(spark):
    assert texts(spark, [30.0, 0.0, -7.0, 1e15, 1e20]) == ["30", "0", "-7", str(10**15), str(10**20)]


def test_fractions_and_exponents(spark):
    numbers = [0.5, 12.75, 0.0001, 0.00012345, 1e-05, 1.5e-07, 2.2e-10, 12345678.25]
    assert texts(spark, numbers) == [python_text(n) for n in numbers]


def test_not_finite_numbers_have_no_text(spark):
    assert texts(spark, [math.inf, -math.inf, math.nan]) == [None, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(
        st.one_of(
            st.integers(-(10**12), 10**12).map(float),
            st.floats(1e-9, 1e12, allow_nan=False).map(lambda x: float(f"{x:.10g}")),
        ),
        min_size=200,
        max_size=200,
    )
)
def test_number_text_equals_python(spark, numbers):
    assert texts(spark, numbers) == [python_text(n) for n in numbers]


def first_values(spark, *value_lists):
    rows = [(i, ("f", values)) for i, values in enumerate(value_lists)]
    schema = f"i int, f {FORM_FIELD.simpleString()}"
    frame = spark.createDataFrame(rows, schema)
    found = frame.select("i", forms.first_value(F.col("f.values")).alias("v")).collect()
    return [r.v for r in sorted(found)]


def test_first_value(spark):
    assert first_values(
        spark,
        [("PROD", None)],
        [(None, 30.0)],
        [("text", 1.0)],
        [(None, None)],
        [],
        None,
        [(None, None), ("", None), ("later", None)],
        [(None, None), (None, 2.5)],
    ) == ["PROD", "30", "text", None, None, None, "", "2.5"]


def test_duration_text(spark):
    cases = [
        "30", "30.9", "-2.7", " 7 ", "1_000", "1e3", ".5", "5.", "+3", "-0", "\t12\n",
        "", "abc", "not-a-number", "30d", "1__0", "_1", "0x10", "nan", "1e", "e5", ".",
        "inf", "-Infinity", "1e400", "1e25",
    ]
    frame = spark.createDataFrame([(c,) for c in cases], "s string")
    rows = frame.select(
        "s",
        forms.duration_days(F.col("s")).alias("days"),
        forms.duration_problem(F.col("s")).alias("problem"),
    ).collect()
    for row in rows:
        try:
            expected = int(float(row.s))
        except (ValueError, OverflowError):
            expected = None
        if expected is not None and abs(expected) > 2**63:
            expected = None
        assert row.days == expected, row
        assert (row.problem is None) == (expected is not None), row


def nested(spark, **values):
    row = {
        "seq": 1,
        "urn": "urn:li:actionRequest:1",
        "type": "WORKFLOW_FORM_REQUEST",
        "status": "COMPLETED",
        "result": "ACCEPTED",
        "resultNote": "ok",
        "entity": ("urn:li:dataset:x",),
        "assignedUsers": ["urn:li:corpuser:a", "urn:li:corpuser:b"],
        "assignedGroups": ["urn:li:corpGroup:g"],
        "created": (1700000000000, ("urn:li:corpuser:alice",)),
        "dueDate": None,
        "params": (([], None),),
    }
    row.update(values)
    return spark.createDataFrame([tuple(row[n] for n in ACTION_REQUESTS.names)], ACTION_REQUESTS)


def form(*fields):
    return ((list(fields), None),)


def flat_row(frame, config=None):
    return requests.flatten(frame, config or Settings(as_of_ms=AS_OF_MS)).first()


def test_flatten_maps_configured_fields(spark):
    fields = form(
        ("snowflake_database", [("PROD", None)]),
        ("snowflake_role", [(None, None), ("ANALYST", None)]),
        ("access_duration_days", [(None, 30.0)]),
        ("cost_center", [("42", None)]),
    )
    row = flat_row(nested(spark, params=fields))
    assert (row.snowflake_database, row.snowflake_role, row.snowflake_schema) == (
        "PROD", "ANALYST", None,
    )
    assert row.access_duration_days == 30 and row.duration_raw == "30"
    assert row.raw == {
        "snowflake_database": "PROD",
        "snowflake_role": "ANALYST",
        "access_duration_days": "30",
        "cost_center": "42",
    }
    assert row.assigned_users == ["urn:li:corpuser:a", "urn:li:corpuser:b"]


def test_flatten_takes_custom_field_ids(spark):
    config = Settings(as_of_ms=AS_OF_MS, fields=FieldIds(database="db", role=""))
    row = flat_row(nested(spark, params=form(("db", [("X", None)]), ("snowflake_role", [("R", None)]))), config)
    assert row.snowflake_database == "X" and row.snowflake_role is None


def test_last_repeated_field_with_a_value_counts(spark):
    fields = form(
        ("snowflake_role", [("FIRST", None)]),
        ("snowflake_role", [("SECOND", None)]),
        ("snowflake_role", [(None, None)]),
    )
    row = flat_row(nested(spark, params=fields))
    assert row.snowflake_role == "SECOND" and row.raw == {"snowflake_role": "SECOND"}


@pytest.mark.parametrize("params", [None, (None,), ((None, None),), (([], None),)])
def test_missing_form_gives_nulls(spark, params):
    row = flat_row(nested(spark, params=params))
    assert row.snowflake_role is None and row.access_duration_days is None and row.raw == {}


def test_missing_entity_actor_and_lists(spark):
    row = flat_row(
        nested(spark, entity=None, created=(5, None), assignedUsers=None, assignedGroups=None)
    )
    assert (row.resource, row.requestor_urn, row.created_ms) == (None, None, 5)
    assert row.assigned_users == [] and row.assigned_groups == []


def test_bad_duration_keeps_the_row(spark):
    row = flat_row(nested(spark, params=form(("access_duration_days", [("not-a-number", None)]))))
    assert row.access_duration_days is None and row.duration_raw == "not-a-number"
