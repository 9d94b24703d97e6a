"""Request forms checked against their declared fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions.forms import value_text
from grantline.sources.forms import FormSpec


def _has_value(value: Column) -> Column:
    return value["stringValue"].isNotNull() | value["numberValue"].isNotNull()


def _values(fields: Column, field_id: str) -> Column:
    """Values of the last field of that id that has any."""
    lists = F.transform(
        F.filter(fields, lambda f: f["id"] == field_id),
        lambda f: F.filter(f["values"], _has_value),
    )
    return F.coalesce(
        F.try_element_at(F.filter(lists, lambda values: F.size(values) > 0), F.lit(-1)),
        F.array().cast("array<struct<stringValue:string,numberValue:double>>"),
    )


def _rule(broken: Column, field_id: str, name: str) -> Column:
    return F.when(broken, F.struct(F.lit(field_id).alias("field_id"), F.lit(name).alias("rule")))


def _field_rules(fields: Column, spec: FormSpec) -> list[Column]:
    values = _values(fields, spec.field_id)
    rules = []
    if spec.required:
        rules.append(_rule(F.size(values) == 0, spec.field_id, "missing_required"))
    if spec.cardinality == "SINGLE":
        rules.append(_rule(F.size(values) > 1, spec.field_id, "too_many_values"))
    wrong = "numberValue" if spec.value_type == "NUMBER" else "stringValue"
    rules.append(
        _rule(F.exists(values, lambda v: v[wrong].isNull()), spec.field_id, "wrong_type")
    )
    if spec.allowed_values:
        allowed = list(spec.allowed_values)
        rules.append(
            _rule(
                F.exists(values, lambda v: ~value_text(v).isin(allowed)),
                spec.field_id,
                "not_allowed",
            )
        )
    return rules


def violations(requests: DataFrame, specs: Iterable[FormSpec]) -> DataFrame:
    """``(urn, field_id, rule)`` for every broken rule of one workflow's requests.

    The handful of specs becomes part of the expression: one scan, no join, no shuffle.
    """
    specs = list(specs)
    form = F.coalesce(
        F.col("params.workflowFormRequest.fields"),
        F.array().cast(
            "array<struct<id:string,values:array<struct<stringValue:string,numberValue:double>>>>"
        ),
    )
    fields = F.col("_fields")
    known = [spec.field_id for spec in specs]
    declared = F.array(*[rule for spec in specs for rule in _field_rules(fields, spec)])
    unknown = F.transform(
        F.array_distinct(
            F.transform(F.filter(fields, lambda f: ~f["id"].isin(known)), lambda f: f["id"])
        ),
        lambda i: F.struct(i.alias("field_id"), F.lit("unknown_field").alias("rule")),
    )
    broken = F.filter(F.concat(declared, unknown), lambda rule: rule.isNotNull())
    return (
        requests.select("urn", form.alias("_fields"))
        .select("urn", F.explode(broken).alias("_broken"))
        .select("urn", "_broken.field_id", "_broken.rule")
    )
