"""Request listings: typed files, and JSON lines with a schema check per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantline import schemas
from grantline.checkpoints import written
from grantline.operators.requests import first_per_urn
from grantline.operators.skew import hot_keys

BUCKET = "urn_bucket"
#: Copies of one URN from which they collapse before they are laid out.
MANY_COPIES = 10_000


def read_requests(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Typed listing; nothing is inferred."""
    return spark.read.schema(schemas.ACTION_REQUESTS).format(source).load(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw listing for :func:`checked`: ``seq`` and ``value``, a JSON document per line.

    ``seq`` numbers the lines from 0 without gaps, files in the order of their paths and lines
    in the order of the file, however Spark splits and plans the files. Lines are written once,
    numbered within their split; the splits' counts are summed up in order and added.
    """
    split = ["path", "block"]
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    lines = written(lines, "lines")
    counts = lines.groupBy(*split).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    bases = _running_totals(counts, split, "n")
    # A task reads a split in one go: its lines have consecutive ids.
    return lines.join(bases, split).select(
        (F.col("before") + F.col("id") - F.col("first")).alias("seq"), "value"
    )


def _running_totals(rows: DataFrame, order: list[str], number: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``number`` over all rows that come earlier.

    Rows are range-partitioned, summed within each part, and the totals of the parts added: no
    task sees more than its part and one row per part.
    """
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = written(ranged, "totals")
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part").agg(F.sum(number).alias("total"))
    # One row per part, of which there are as many as shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    summed = parts.withColumn("inside", F.coalesce(F.sum(number).over(within), F.lit(0)))
    return summed.join(bases, "part").select(
        *rows.columns, (F.col("inside") + F.col("base")).alias("before")
    )


# The wire shape with untyped leaves, so that each leaf's own type can be checked.
_WIRE = """
urn variant, type variant, status variant, result variant, resultNote variant,
entity struct<urn: variant>, assignedUsers variant, assignedGroups variant,
created struct<time: variant, actor: struct<urn: variant>>, dueDate variant,
params struct<workflowFormRequest: struct<fields: variant, access: struct<expiresAt: variant>>>,
_corrupt string
"""
_FIELDS = "array<struct<id:variant,values:variant>>"
_VALUES = "array<struct<stringValue:variant,numberValue:variant>>"
_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"
# A cast alone would take a type suffix, as in "30d", for part of the number.
_NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _as(leaf: Column, type_name: str) -> Column:
    return F.try_variant_get(leaf, "$", type_name)


def _missing(leaf: Column) -> Column:
    return leaf.isNull() | (F.schema_of_variant(leaf) == "VOID")


def _is_text(leaf: Column) -> Column:
    return F.coalesce(F.schema_of_variant(leaf) == "STRING", F.lit(False))


def _is_number(leaf: Column) -> Column:
    """A number, a truth value (1 or 0), or text that reads as a number."""
    kind = F.schema_of_variant(leaf)
    as_text = (kind == "STRING") & _as(leaf, "string").rlike(_NUMBER_TEXT)
    numeric = kind.rlike(_NUMBER) | (as_text & _as(leaf, "double").isNotNull())
    return F.coalesce(numeric, F.lit(False))


def _is_whole(leaf: Column) -> Column:
    number = _as(leaf, "double")
    whole = (number == F.rint(number)) & _as(leaf, "bigint").isNotNull()
    return _is_number(leaf) & F.coalesce(whole, F.lit(False))


def _is_list_of_text(leaf: Column) -> Column:
    items = F.forall(_as(leaf, "array<variant>"), _is_text)
    return F.coalesce(F.schema_of_variant(leaf).startswith("ARRAY") & items, F.lit(False))


def _is_value(value: Column) -> Column:
    return (
        value.isNotNull()
        & (_missing(value["stringValue"]) | _is_text(value["stringValue"]))
        & (_missing(value["numberValue"]) | _is_number(value["numberValue"]))
    )


def _is_field(field: Column) -> Column:
    values = F.forall(_as(field["values"], _VALUES), _is_value)
    return _is_text(field["id"]) & (field["values"].isNull() | F.coalesce(values, F.lit(False)))


def _reason(document: Column) -> Column:
    """First rule a document breaks, else null."""
    doc = F.col("_doc")
    form = doc["params"]["workflowFormRequest"]
    corrupt = doc["_corrupt"].isNotNull()
    unreadable = doc.isNull() | (corrupt & F.try_parse_json(document).isNull())
    reason = F.when(F.col("seq").isNull(), F.lit("missing:seq"))
    reason = reason.when(unreadable, F.lit("malformed_json"))
    reason = reason.when(
        corrupt & ~F.startswith(F.ltrim(document), F.lit("{")), F.lit("not_an_object")
    ).when(corrupt, F.lit("bad_type:structure"))
    for name in ("urn", "type", "status"):
        reason = reason.when(_missing(doc[name]), F.lit(f"missing:{name}")).when(
            ~_is_text(doc[name]), F.lit(f"bad_type:{name}")
        )
    time = doc["created"]["time"]
    reason = reason.when(_missing(time), F.lit("missing:created.time")).when(
        ~_is_whole(time), F.lit("bad_type:created.time")
    )
    for name in ("result", "resultNote"):
        reason = reason.when(
            ~(_missing(doc[name]) | _is_text(doc[name])), F.lit(f"bad_type:{name}")
        )
    for name, ref in (("entity", doc["entity"]), ("created.actor", doc["created"]["actor"])):
        reason = reason.when(ref.isNotNull() & ~_is_text(ref["urn"]), F.lit(f"bad_type:{name}"))
    for name in ("assignedUsers", "assignedGroups"):
        reason = reason.when(
            doc[name].isNotNull() & ~_is_list_of_text(doc[name]), F.lit(f"bad_type:{name}")
        )
    for name, leaf in (("dueDate", doc["dueDate"]), ("expiresAt", form["access"]["expiresAt"])):
        reason = reason.when(~(_missing(leaf) | _is_whole(leaf)), F.lit(f"bad_type:{name}"))
    fields = F.forall(_as(form["fields"], _FIELDS), _is_field)
    return reason.when(
        form["fields"].isNotNull() & ~F.coalesce(fields, F.lit(False)), F.lit("bad_type:fields")
    )


def _typed() -> dict[str, Column]:
    """The request's columns, from a document that passed the check."""
    doc = F.col("_doc")
    form = doc["params"]["workflowFormRequest"]
    types = {f.name: f.dataType.simpleString() for f in schemas.ACTION_REQUESTS.fields}
    fields_type = schemas.ACTION_REQUESTS["params"].dataType["workflowFormRequest"].dataType[
        "fields"
    ].dataType.simpleString()

    def ref(outer: Column) -> Column:
        return F.when(outer.isNotNull(), F.struct(_as(outer["urn"], "string").alias("urn")))

    def listed(leaf: Column) -> Column:
        return F.coalesce(_as(leaf, "array<string>"), F.array().cast("array<string>"))

    access = form["access"]
    columns = {
        "urn": _as(doc["urn"], "string"),
        "type": _as(doc["type"], "string"),
        "status": _as(doc["status"], "string"),
        "result": _as(doc["result"], "string"),
        "resultNote": _as(doc["resultNote"], "string"),
        "entity": ref(doc["entity"]),
        "assignedUsers": listed(doc["assignedUsers"]),
        "assignedGroups": listed(doc["assignedGroups"]),
        "created": F.struct(
            _as(doc["created"]["time"], "bigint").alias("time"),
            ref(doc["created"]["actor"]).alias("actor"),
        ),
        "dueDate": _as(doc["dueDate"], "bigint"),
        "params": F.when(
            doc["params"].isNotNull(),
            F.struct(
                F.when(
                    form.isNotNull(),
                    F.struct(
                        _as(form["fields"], fields_type).alias("fields"),
                        F.when(
                            access.isNotNull(),
                            F.struct(_as(access["expiresAt"], "bigint").alias("expiresAt")),
                        ).alias("access"),
                    ),
                ).alias("workflowFormRequest")
            ),
        ),
    }
    good = F.col("reason").isNull()
    return {name: F.when(good, c).cast(types[name]) for name, c in columns.items()}


def checked(raw: DataFrame, column: str = "value") -> DataFrame:
    """Typed request columns plus ``reason``: null for a good row.

    ``raw`` has the documents and their place ``seq`` in the listing. Each document is
    parsed once. A bad row does not take its neighbours along; other columns are kept.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = raw.withColumn("_doc", F.from_json(F.col(column), _WIRE, options))
    judged = parsed.withColumn("reason", _reason(F.col(column)))
    return judged.withColumns(_typed()).drop("_doc")


def good_rows(rows: DataFrame, column: str = "value") -> DataFrame:
    return rows.filter(F.col("reason").isNull()).drop("reason", column)


def bad_rows(rows: DataFrame, column: str = "value") -> DataFrame:
    """Quarantine rows of a checked listing, with the document as it came."""
    return rows.filter(F.col("reason").isNotNull()).select(
        F.get_json_object(F.col(column), "$.urn").alias("urn"),
        "reason",
        F.col(column).alias("detail"),
    )


def bucket_of(urn: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(urn), F.lit(buckets)).cast("int")


def _few_copies(requests: DataFrame) -> DataFrame:
    """Requests with one row for a URN of which there are very many."""
    key = F.coalesce("urn", F.lit(""))
    many = written(hot_keys(requests.select(key.alias("key")), MANY_COPIES), "many")
    if many.isEmpty():
        return requests
    marked = requests.join(F.broadcast(many), key == many["key"], "left")
    often = marked.where("key IS NOT NULL").drop("key")
    return marked.where("key IS NULL").drop("key").unionByName(first_per_urn(often))


def write_current_requests(requests: DataFrame, path: str, buckets: int) -> None:
    """Current requests, one row per URN, laid out for look-ups by URN.

    Partitioned by a hash of the URN and range-split by URN inside, so that a large
    bucket is written by several tasks, a look-up reads one directory and few row
    groups, and a join with a small set of URNs prunes directories at run time.

    Whole requests are shuffled once, to their place; copies of a URN meet there. Those of a URN
    with very many collapse before.
    """
    rows = _few_copies(requests.select(*schemas.ACTION_REQUESTS.names))
    placed = rows.withColumn(BUCKET, bucket_of(F.col("urn"), buckets))
    (
        first_per_urn(placed.repartitionByRange(BUCKET, "urn"), BUCKET)
        .select(*schemas.ACTION_REQUESTS.names, BUCKET)
        .sortWithinPartitions(BUCKET, "urn")
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def read_current_requests(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        [*schemas.ACTION_REQUESTS.fields, T.StructField(BUCKET, T.IntegerType())]
    )
    return spark.read.schema(schema).parquet(path)


def point_lookup(current: DataFrame, urn: str, buckets: int) -> DataFrame:
    """One request or none."""
    return current.filter(
        (F.col(BUCKET) == bucket_of(F.lit(urn), buckets)) & (F.col("urn") == urn)
    )


def bucket_lookup(current: DataFrame, urns: DataFrame, buckets: int) -> DataFrame:
    """Requests of a small set of URNs; directories without any of them are not read."""
    wanted = urns.select("urn", bucket_of(F.col("urn"), buckets).alias(BUCKET))
    return current.join(wanted, [BUCKET, "urn"], "left_semi")
