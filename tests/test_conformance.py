from pyspark.sql import functions as F

from grantline.operators.conformance import violations
from grantline.settings import FieldIds
from grantline.sources.forms import (
    PRIORITIES,
    access_request_specs,
    form_specs,
    product_request_specs,
)
from tests.builders import rows_of
from tests.test_forms import form, nested

FULL = [
    ("snowflake_database", [("PROD", None)]),
    ("snowflake_role", [("R", None)]),
    ("requestor_email", [("a@b.c", None)]),
    ("justification", [("because", None)]),
]


def broken(spark, fields, specs=None):
    frame = nested(spark, params=form(*fields) if fields is not None else None)
    return rows_of(violations(frame, specs or access_request_specs()), "field_id", "rule")


def test_a_complete_form_breaks_nothing(spark):
    assert broken(spark, [*FULL, ("access_duration_days", [(None, 30.0)])]) == []


def test_missing_required_fields(spark):
    assert broken(spark, None) == [
        ("justification", "missing_required"),
        ("requestor_email", "missing_required"),
        ("snowflake_database", "missing_required"),
        ("snowflake_role", "missing_required"),
    ]
    assert broken(spark, [*FULL[:3], ("justification", [(None, None)])]) == [
        ("justification", "missing_required")
    ]


def test_types_cardinality_and_unknown_fields(spark):
    fields = [
        *FULL,
        ("access_duration_days", [("30", None)]),
        ("snowflake_schema", [("A", None), ("B", None)]),
        ("ticket", [("T", None)]),
        ("ticket", [("U", None)]),
    ]
    assert broken(spark, fields) == [
        ("access_duration_days", "wrong_type"),
        ("snowflake_schema", "too_many_values"),
        ("ticket", "unknown_field"),
    ]
    assert broken(spark, [*FULL[:1], ("snowflake_role", [(None, 5.0)]), *FULL[2:]]) == [
        ("snowflake_role", "wrong_type")
    ]


def test_product_form(spark):
    fields = [
        ("product_name", [("Churn", None)]),
        ("business_domain", [("Retail", None)]),
        ("use_case", [("KPIs", None)]),
        ("priority", [("Urgent", None)]),
        ("requestor_email", [("a@b.c", None)]),
    ]
    specs = product_request_specs()
    assert broken(spark, fields, specs) == [("priority", "not_allowed")]
    fields[3] = ("priority", [(PRIORITIES[2], None)])
    assert broken(spark, fields, specs) == []


def test_spec_table(spark):
    table = form_specs(spark, FieldIds(database="db"))
    assert table.count() == 11
    assert table.filter(F.size("allowed_values") == 4).first().field_id == "priority"
    assert table.filter("required = false").count() == 2
    assert table.filter("field_id = 'db'").count() == 1
