"""Request, event and state tables derived from the given parquet tables.

The views are plain SQL that Spark and DuckDB both read; only the expression for
epoch milliseconds differs. Every order is one access request, every event one
change event, so all of them grow with the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantline import schemas
from grantline.functions import forms
from grantline.operators.skew import by_shuffle
from grantline.settings import Settings

# 2001-08-01 00:00:00 UTC, the day after the last order.
AS_OF_MS = 996624000000

SETTINGS = Settings(
    as_of_ms=AS_OF_MS,
    escalation_recipients=("lead@example.com", "chief@example.com"),
    default_warehouse="QUERY_WH",
)

# Declared, so that reading infers nothing.
SOURCES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

VIEWS: dict[str, str] = {
    "requests": """
select o_orderkey as seq,
  concat('urn:li:actionRequest:', cast(o_orderkey as string)) as urn,
  case when o_orderkey % 20 = 0 then 'OTHER_REQUEST' else 'WORKFLOW_FORM_REQUEST' end as request_type,
  case o_orderstatus when 'O' then 'PENDING' else 'COMPLETED' end as status,
  case o_orderstatus when 'F' then 'ACCEPTED' when 'P' then 'REJECTED' end as result,
  case when o_orderkey % 3 = 0 then null when o_orderkey % 8 = 1 then ''
       else concat('note ', cast(o_orderkey as string)) end as note,
  case when o_orderkey % 19 = 0 then null else concat('urn:li:dataset:', n_name) end as resource,
  case when o_orderstatus <> 'O' then {order_ms} + (o_orderkey % 24) * 3600000
       when o_orderkey % 97 = 0 then 0
       else 996624000000 - (o_orderkey % 240) * 1800000 end as created_ms,
  case when c_custkey % 50 = 7 then concat('urn:li:corpGroup:g', cast(c_custkey as string))
       when o_orderkey % 71 = 0 then null
       when c_custkey % 2 = 0 then concat('urn:li:corpuser:user', cast(c_custkey as string), '@example.com')
       else concat('urn:li:corpuser:user', cast(c_custkey as string)) end as requestor_urn,
  case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then ''
       when c_mktsegment = 'BUILDING' then 'BUILDING_ROLE'
       else concat(c_mktsegment, '_ROLE_', cast(c_custkey % 200 as string)) end as snowflake_role,
  case when o_orderkey % 37 = 0 then null else n_name end as snowflake_database,
  case when o_orderpriority = '4-NOT SPECIFIED' then null when o_orderkey % 13 = 0 then ''
       when o_orderkey % 41 = 0 then 'BAD NAME'
       else substr(o_orderpriority, 3) end as snowflake_schema,
  case when o_orderkey % 9 = 0 then null when o_orderkey % 17 = 0 then 'not-a-number'
       when o_orderkey % 43 = 0 then '12.9' when o_orderkey % 47 = 0 then '-3'
       when o_orderkey % 53 = 0 then 'inf' when o_orderkey % 59 = 0 then '30d'
       when o_orderkey % 67 = 0 then '10000000' when o_orderkey % 73 = 0 then '-10000000'
       else cast(o_orderkey % 61 as string) end as duration_raw,
  case when o_orderkey % 5 = 0 then null when o_orderkey % 23 = 0 then ''
       else concat('user', cast(c_custkey as string), '@example.com') end as requestor_email,
  case when o_orderkey % 6 = 0 then null else 'quarterly report' end as justification,
  case when o_orderkey % 4 = 0 then null
       else concat('urn:li:corpuser:owner', cast(n_nationkey as string)) end as owner_urn,
  case when o_orderkey % 10 = 3 then concat('urn:li:corpGroup:stewards', cast(n_nationkey as string)) end as group_urn,
  o_orderpriority as priority,
  o_totalprice as amount
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""",
    "user_properties": """
select case when c_custkey % 2 = 0 then concat('user', cast(c_custkey as string), '@example.com')
            else concat('user', cast(c_custkey as string)) end as username,
  'DEFAULT_ROLE' as property,
  case when c_custkey % 4 = 0 then '' when c_custkey % 27 = 5 then '   '
       else concat(' ', c_mktsegment, '_DEFAULT ') end as value
from customer where c_acctbal > 500
union all
select case when c_custkey % 2 = 0 then concat('user', cast(c_custkey as string), '@example.com')
            else concat('user', cast(c_custkey as string)) end,
  'DEFAULT_WAREHOUSE', 'LOAD_WH'
from customer
""",
    "grants": """
select snowflake_role, snowflake_database, coalesce(snowflake_schema, '') as snowflake_schema,
  urn as latest_action_request_urn, nullif(requestor_email, '') as requestor_email,
  created_ms as granted_at_ms,
  case when seq % 61 > 0 then created_ms + (seq % 61) * 86400000 end as expires_at_ms,
  case when seq % 4 = 0 then created_ms + 86400000 end as revoked_at_ms
from requests
where seq in (
  select max(seq) from requests
  where request_type = 'WORKFLOW_FORM_REQUEST' and status = 'COMPLETED' and result = 'ACCEPTED'
    and snowflake_role <> '' and snowflake_database is not null
    and (created_ms < 988848000000 or amount > 400000)
  group by snowflake_role, snowflake_database, coalesce(snowflake_schema, ''))
""",
    "sla_notifications": """
select urn as action_request_urn, 'warning' as notification_type
from requests where status = 'PENDING' and priority in ('1-URGENT', '2-HIGH')
union all
select urn, 'escalation' from requests where status = 'PENDING' and priority = '1-URGENT'
""",
    "provisioning_errors": """
select urn as action_request_urn, '2003' as snowflake_error_code, 'object does not exist' as error_message
from requests where result = 'ACCEPTED' and amount > 450000
""",
    "change_events": """
select event_id,
  case event_type when 'error' then 'EntityChangeEvent_v1' else 'MetadataChangeLogEvent_v1' end as event_type,
  case event_type when 'signup' then 'dataset' else 'actionRequest' end as entity_type,
  case event_type when 'view' then 'actionRequestInfo' else 'actionRequestStatus' end as aspect_name,
  case when event_id % 50 = 0 then null when event_id % 51 = 0 then ''
       when event_id % 29 = 0 then concat('urn:li:actionRequest:none', cast(event_id % 7 as string))
       when event_id % 3 = 0 then 'urn:li:actionRequest:1'
       else concat('urn:li:actionRequest:', cast(event_id - event_id % 4 as string)) end as entity_urn,
  ts as event_ts
from events
""",
}

_NEEDS = {
    "requests": ("orders", "customer", "nation"),
    "user_properties": ("customer",),
    "grants": ("requests",),
    "sla_notifications": ("requests",),
    "provisioning_errors": ("requests",),
    "change_events": ("events",),
}


def view_sql(name: str, order_ms: str) -> str:
    return VIEWS[name].replace("{order_ms}", order_ms)


def staged(build: Callable[[SparkSession, str], DataFrame]):
    """Let a table come from a folder of its name, if :func:`use_staged` names ``sf_dir``.

    The bench writes the derived tables there first and so measures the operators.
    """
    name = build.__name__

    def read_or_build(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = f"{sf_dir}/{name}"
        if sf_dir in _STAGED_FOLDERS:
            return spark.read.parquet(folder)
        return build(spark, sf_dir)

    STAGED[name] = build
    return read_or_build


STAGED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_STAGED_FOLDERS: set[str] = set()


def use_staged(folder: str) -> None:
    """From now on read the derived tables from ``folder`` where it is given as ``sf_dir``."""
    _STAGED_FOLDERS.add(folder)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a frame; nested views are built from their own sources."""
    if name in SOURCES:
        return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")
    frames = {need: view(spark, sf_dir, need) for need in _NEEDS[name]}
    if name == "requests":
        # Grows with the orders: not to be sent through the driver while it is small.
        frames["customer"] = by_shuffle(frames["customer"])
    text = view_sql(name, "unix_millis(cast(o_orderdate as timestamp))")
    for need in sorted(frames, key=len, reverse=True):
        for keyword in ("from", "join"):
            text = text.replace(f"{keyword} {need} ", f"{keyword} {{{need}}} ")
            text = text.replace(f"{keyword} {need}\n", f"{keyword} {{{need}}}\n")
    return spark.sql(text, **frames)


@staged
def flat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat requests with the columns that :func:`flatten` gives."""
    empty = F.array().cast("array<string>")
    return view(spark, sf_dir, "requests").withColumns(
        {
            "access_duration_days": forms.duration_days(F.col("duration_raw")),
            "assigned_users": F.when(
                F.col("owner_urn").isNotNull(),
                F.array("owner_urn", F.lit("urn:li:corpuser:deputy")),
            ).otherwise(empty),
            "assigned_groups": F.when(
                F.col("group_urn").isNotNull(), F.array("group_urn")
            ).otherwise(empty),
        }
    )


@staged
def user_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "user_properties")


@staged
def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants table before the pass, with timestamps."""
    rows = view(spark, sf_dir, "grants")
    return rows.select(
        "snowflake_role",
        "snowflake_database",
        "snowflake_schema",
        "latest_action_request_urn",
        "requestor_email",
        F.timestamp_millis("granted_at_ms").alias("granted_at"),
        F.timestamp_millis("expires_at_ms").alias("expires_at"),
        F.timestamp_millis("revoked_at_ms").alias("revoked_at"),
    )


@staged
def sla_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = F.timestamp_millis(F.lit(AS_OF_MS - 86_400_000))
    return view(spark, sf_dir, "sla_notifications").withColumn("sent_at", sent)


@staged
def provisioning_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.timestamp_millis(F.lit(AS_OF_MS - 86_400_000))
    return view(spark, sf_dir, "provisioning_errors").withColumn("failed_at", failed)


@staged
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "change_events").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp")
    )


_VALUE = "struct<stringValue:string,numberValue:double>"


def _value(text: Column | None = None, number: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None) if text is None else text).cast("string").alias("stringValue"),
        (F.lit(None) if number is None else number).cast("double").alias("numberValue"),
    )


def _field(field_id: str, values: Column) -> Column:
    return F.struct(F.lit(field_id).alias("id"), values.alias("values"))


def _text_values(text: Column) -> Column:
    seq = F.col("seq")
    return (
        F.when(text.isNull() & (seq % 2 == 0), F.array(_value()))
        .when(text.isNull(), F.array().cast(f"array<{_VALUE}>"))
        .when(seq % 4 == 1, F.array(_value(), _value(text)))
        .otherwise(F.array(_value(text)))
    )


def pack(flat: DataFrame) -> DataFrame:
    """Flat requests in the nested wire shape, with its irregularities.

    Leading empty values, a second schema value, numbers as numbers or text, an
    outdated entry for the role in front of the valid one, a field that no form
    declares.
    """
    seq = F.col("seq")
    duration = F.col("duration_raw")
    as_number = (seq % 2 == 0) & duration.rlike("^-?[0-9.]+$")
    schema_values = _text_values(F.col("snowflake_schema"))
    fields = F.filter(
        F.array(
            F.when(
                (seq % 5 == 2) & F.col("snowflake_role").isNotNull(),
                _field("snowflake_role", F.array(_value(F.lit("OUTDATED")))),
            ),
            _field("snowflake_database", _text_values(F.col("snowflake_database"))),
            _field(
                "snowflake_schema",
                F.when(
                    (seq % 14 == 5) & F.col("snowflake_schema").isNotNull(),
                    F.concat(schema_values, F.array(_value(F.lit("SECOND")))),
                ).otherwise(schema_values),
            ),
            _field("snowflake_role", _text_values(F.col("snowflake_role"))),
            _field(
                "access_duration_days",
                F.when(
                    as_number, F.array(_value(number=duration.try_cast("double")))
                ).otherwise(_text_values(duration)),
            ),
            _field("requestor_email", _text_values(F.col("requestor_email"))),
            _field("justification", _text_values(F.col("justification"))),
            F.when(seq % 21 == 4, _field("ticket", F.array(_value(F.lit("T-1"))))),
        ),
        lambda f: f.isNotNull(),
    )
    no_ref = F.lit(None).cast("struct<urn:string>")
    return flat.select(
        "seq",
        "urn",
        F.col("request_type").alias("type"),
        "status",
        "result",
        F.col("note").alias("resultNote"),
        F.when(F.col("resource").isNotNull(), F.struct(F.col("resource").alias("urn")))
        .otherwise(no_ref)
        .alias("entity"),
        F.col("assigned_users").alias("assignedUsers"),
        F.col("assigned_groups").alias("assignedGroups"),
        F.struct(
            F.col("created_ms").alias("time"),
            F.when(
                F.col("requestor_urn").isNotNull(), F.struct(F.col("requestor_urn").alias("urn"))
            )
            .otherwise(no_ref)
            .alias("actor"),
        ).alias("created"),
        F.lit(None).cast("bigint").alias("dueDate"),
        F.struct(
            F.struct(
                fields.alias("fields"),
                F.lit(None).cast("struct<expiresAt:bigint>").alias("access"),
            ).alias("workflowFormRequest")
        ).alias("params"),
    )


@staged
def nested_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(flat_requests(spark, sf_dir)).select(*schemas.ACTION_REQUESTS.names)


@staged
def product_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for new data products, one per part, in the nested wire shape."""
    size = F.col("p_size")
    priority = (
        F.when(size <= 10, F.lit("Low — nice to have"))
        .when(size <= 20, F.lit("High — blocking current work"))
        .when(size <= 30, F.lit("Urgent"))
    )
    text = {
        "product_name": F.col("p_name"),
        "business_domain": F.col("p_brand"),
        "use_case": F.when(size != 7, F.col("p_type")),
        "priority": priority,
    }
    fields = [
        _field(name, F.filter(F.array(_value(v)), lambda x: x["stringValue"].isNotNull()))
        for name, v in text.items()
    ]
    mail = _field("requestor_email", F.array(_value(number=F.col("p_retailprice"))))
    form = F.struct(
        F.struct(
            F.array(*fields, mail).alias("fields"),
            F.lit(None).cast("struct<expiresAt:bigint>").alias("access"),
        ).alias("workflowFormRequest")
    )
    urn = F.concat(F.lit("urn:li:actionRequest:part"), F.col("p_partkey").cast("string"))
    return view(spark, sf_dir, "part").select(urn.alias("urn"), form.alias("params"))


@staged
def json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, value)``: requests as JSON text, some of them damaged."""
    rows = nested_requests(spark, sf_dir)
    text = rows.select(
        "seq", F.to_json(F.struct(*[c for c in rows.columns if c != "seq"])).alias("v")
    )
    v, kind = F.col("v"), F.col("seq") % 40
    return text.select(
        "seq",
        F.when(kind == 1, F.expr("substr(v, 1, length(v) - 5)"))
        .when(kind == 2, F.concat(F.lit("["), v, F.lit("]")))
        .when(kind == 3, F.regexp_replace(v, '"status":"[A-Z]+"', '"status":7'))
        .when(kind == 4, F.regexp_replace(v, '"status":"[A-Z]+",', ""))
        .when(kind == 5, F.replace(v, F.lit('"time":'), F.lit('"tyme":')))
        .when(kind == 6, F.regexp_replace(v, '"time":[0-9]+', '"time":"soon"'))
        .when(kind == 7, F.regexp_replace(v, '"time":([0-9]+)', '"time":"$1"'))
        .when(kind == 8, F.replace(v, F.lit('"id":"justification"'), F.lit('"id":5')))
        .when(kind == 9, F.replace(v, F.lit('"assignedUsers":['), F.lit('"assignedUsers":[7,')))
        .when(kind == 11, F.replace(v, F.lit('"values":[{'), F.lit('"values":[{"numberValue":"30d"},{')))
        .when(kind == 12, F.replace(v, F.lit('"values":[{'), F.lit('"values":[{"numberValue":"1.5"},{')))
        .when(kind == 13, F.replace(v, F.lit('"values":[{'), F.lit('"values":[{"numberValue":true},{')))
        .otherwise(v)
        .alias("value"),
    )


def execute(statements: DataFrame) -> DataFrame:
    """Outcomes in which some requests fail at their second statement and stop there."""
    number = F.substring_index("urn", ":", -1).cast("bigint")
    failing = number % 31 == 0
    broken = failing & (F.col("stmt_no") == 2)
    permanent = number % 62 == 0
    return statements.filter(~(failing & (F.col("stmt_no") > 2))).withColumns(
        {
            "ok": ~broken,
            "errno": F.when(broken & permanent, F.lit(2003)).when(broken, F.lit(604)),
            "message": F.when(broken & permanent, F.lit("object does not exist")).when(
                broken, F.lit("statement timed out")
            ),
        }
    )
