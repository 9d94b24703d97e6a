"""Change events as a static or streaming frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantline import schemas

_ENVELOPE = (
    "event_type string, event struct<entityType: string, aspectName: string, entityUrn: string>,"
    " _corrupt string"
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHANGE_EVENTS).parquet(path)


def stream_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Event files as they arrive. Without a limit one trigger takes all that is there."""
    reader = spark.readStream.schema(schemas.CHANGE_EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def from_envelopes(
    raw: DataFrame, event_id: Column, event_ts: Column, column: str = "value"
) -> DataFrame:
    """Change events from JSON envelopes, static or streaming: text lines or Kafka values.

    Identity and time are the transport's: an envelope has neither. The column
    ``problem`` names what is wrong with an envelope and is null for a good one;
    :func:`rejected_envelopes` gives the others as quarantine rows.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = F.col(column).cast("string")
    parsed = F.from_json(text, _ENVELOPE, options)
    rows = raw.select(
        event_id.cast("long").alias("event_id"),
        event_ts.cast("timestamp").alias("event_ts"),
        text.alias("envelope"),
        parsed.alias("_e"),
    )
    problem = (
        F.when(F.col("_e").isNull() | F.col("_e._corrupt").isNotNull(), "malformed_envelope")
        .when(F.col("event_id").isNull(), "missing:event_id")
        .when(F.col("event_type").isNull(), "missing:event_type")
        .when(F.col("_e.event").isNull(), "missing:event")
    )
    return (
        rows.withColumn("event_type", F.col("_e.event_type"))
        .withColumn("problem", problem)
        .select(
            "event_id",
            "event_type",
            F.col("_e.event.entityType").alias("entity_type"),
            F.col("_e.event.aspectName").alias("aspect_name"),
            F.col("_e.event.entityUrn").alias("entity_urn"),
            "event_ts",
            "problem",
            "envelope",
        )
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).select(*schemas.CHANGE_EVENTS.names)


def rejected_envelopes(parsed: DataFrame) -> DataFrame:
    """Quarantine rows of the envelopes that are no events."""
    return parsed.filter(F.col("problem").isNotNull()).select(
        F.col("entity_urn").alias("urn"),
        F.col("problem").alias("reason"),
        F.col("envelope").alias("detail"),
    )
