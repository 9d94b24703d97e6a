"""Declared fields of the two request forms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from grantline import schemas
from grantline.settings import FieldIds

ACCESS_REQUEST = "access_request"
PRODUCT_REQUEST = "data_product_request"


@dataclass(frozen=True)
class FormSpec:
    workflow: str
    field_id: str
    value_type: str
    cardinality: str = "SINGLE"
    required: bool = True
    allowed_values: tuple[str, ...] = ()


def access_request_specs(ids: FieldIds | None = None) -> list[FormSpec]:
    ids = ids or FieldIds()
    return [
        FormSpec(ACCESS_REQUEST, ids.database, "STRING"),
        FormSpec(ACCESS_REQUEST, ids.schema, "STRING", required=False),
        FormSpec(ACCESS_REQUEST, ids.role, "STRING"),
        FormSpec(ACCESS_REQUEST, ids.duration, "NUMBER", required=False),
        FormSpec(ACCESS_REQUEST, ids.email, "STRING"),
        FormSpec(ACCESS_REQUEST, ids.justification, "RICH_TEXT"),
    ]


# The choices the product form offers.
PRIORITIES = (
    "Low — nice to have",
    "Medium — needed within a month",
    "High — blocking current work",
    "Critical — executive deliverable",
)


def product_request_specs() -> list[FormSpec]:
    return [
        FormSpec(PRODUCT_REQUEST, "product_name", "STRING"),
        FormSpec(PRODUCT_REQUEST, "business_domain", "STRING"),
        FormSpec(PRODUCT_REQUEST, "use_case", "RICH_TEXT"),
        FormSpec(PRODUCT_REQUEST, "priority", "STRING", allowed_values=PRIORITIES),
        FormSpec(PRODUCT_REQUEST, "requestor_email", "STRING"),
    ]


def form_specs(spark: SparkSession, ids: FieldIds | None = None) -> DataFrame:
    """The specs as a table of eleven rows."""
    rows = [
        (s.workflow, s.field_id, s.value_type, s.cardinality, s.required, list(s.allowed_values))
        for s in [*access_request_specs(ids), *product_request_specs()]
    ]
    return spark.createDataFrame(rows, schemas.FORM_SPECS)
