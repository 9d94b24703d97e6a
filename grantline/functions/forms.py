"""Form values: union values, first value, keyed pick, duration text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles from 2^63 on do not fit a bigint.
_BIGINT_LIMIT = 9.223372036854775e18

# A decimal number as the form's own parser takes it: digits may be grouped by
# single underscores, blanks around the number are ignored.
_DIGITS = r"[0-9](_?[0-9])*"
_NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_NOT_FINITE = r"(?i)^[+-]?(inf|infinity)$"
_BLANKS = " \t\n\r\x0b\x0c"


def number_text(number: Column) -> Column:
    """Shortest text of a double: no decimals for whole numbers, exponent only below 1e-4."""
    java = number.cast("string")
    plain = F.rtrim(java.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
    tiny = F.regexp_replace(java, r"\.0E", "E")
    tiny = F.regexp_replace(tiny, r"E-([0-9])$", "e-0$1")
    tiny = F.regexp_replace(tiny, r"E-", "e-")
    whole = number == F.rint(number)
    return (
        F.when(F.isnan(number) | (F.abs(number) == float("inf")), F.lit(None).cast("string"))
        .when(whole & (F.abs(number) < _BIGINT_LIMIT), number.try_cast("bigint").cast("string"))
        .when(whole, F.coalesce(number.try_cast("decimal(38,0)").cast("string"), java))
        .when(F.abs(number) < 1e-4, tiny)
        .otherwise(plain)
    )


def value_text(value: Column) -> Column:
    """Text of one union value: the string if there is one, else the number."""
    return F.coalesce(value["stringValue"], number_text(value["numberValue"]))


def first_value(values: Column) -> Column:
    """Text of the first value that has one. The empty string counts as a value."""
    texts = F.filter(F.transform(values, value_text), lambda text: text.isNotNull())
    return F.get(texts, F.lit(0))


def field_pairs(fields: Column) -> Column:
    """``array<struct<id, val>>`` of the form's fields that have a value, in form order."""
    pairs = F.transform(
        fields, lambda f: F.struct(f["id"].alias("id"), first_value(f["values"]).alias("val"))
    )
    return F.filter(pairs, lambda pair: pair["val"].isNotNull())


def pick(pairs: Column, field_id: str | None) -> Column:
    """Value of one field; of repeated ids the last counts; null for an unknown id."""
    if not field_id:
        return F.lit(None).cast("string")
    return F.try_element_at(F.filter(pairs, lambda p: p["id"] == field_id), F.lit(-1))["val"]


def raw_map(pairs: Column) -> Column:
    """``map<id, val>`` in order of first appearance; of repeated ids the last value counts."""
    ids = F.array_distinct(F.transform(pairs, lambda p: p["id"]))
    last = F.transform(
        ids,
        lambda i: F.try_element_at(F.filter(pairs, lambda p: p["id"] == i), F.lit(-1))["val"],
    )
    return F.map_from_arrays(ids, last)


def _duration_number(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(
        trimmed.rlike(_NUMBER), F.regexp_replace(trimmed, "_", "").try_cast("double")
    )


def duration_days(text: Column) -> Column:
    """Whole days, cut toward zero; null for text that is no finite number."""
    return _duration_number(text).try_cast("bigint")


def duration_problem(text: Column) -> Column:
    """Why a given duration text yields no days, else null."""
    return (
        F.when(text.isNull() | duration_days(text).isNotNull(), F.lit(None).cast("string"))
        .when(F.btrim(text, F.lit(_BLANKS)).rlike(_NOT_FINITE), F.lit("duration_not_finite"))
        .when(_duration_number(text).isNotNull(), F.lit("duration_out_of_range"))
        .otherwise(F.lit("duration_unparsable"))
    )
