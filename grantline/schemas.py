"""Schemas of the inputs, the state and the outboxes."""

from pyspark.sql import types as T

VALUE = T.StructType(
    [T.StructField("stringValue", T.StringType()), T.StructField("numberValue", T.DoubleType())]
)
FORM_FIELD = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("values", T.ArrayType(VALUE))]
)
URN_REF = T.StructType([T.StructField("urn", T.StringType())])

ACTION_REQUESTS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("urn", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("resultNote", T.StringType()),
        T.StructField("entity", URN_REF),
        T.StructField("assignedUsers", T.ArrayType(T.StringType())),
        T.StructField("assignedGroups", T.ArrayType(T.StringType())),
        T.StructField(
            "created",
            T.StructType(
                [T.StructField("time", T.LongType()), T.StructField("actor", URN_REF)]
            ),
        ),
        T.StructField("dueDate", T.LongType()),
        T.StructField(
            "params",
            T.StructType(
                [
                    T.StructField(
                        "workflowFormRequest",
                        T.StructType(
                            [
                                T.StructField("fields", T.ArrayType(FORM_FIELD)),
                                T.StructField(
                                    "access",
                                    T.StructType([T.StructField("expiresAt", T.LongType())]),
                                ),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)

CHANGE_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("aspect_name", T.StringType()),
        T.StructField("entity_urn", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

USER_PROPERTIES = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("property", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("default", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
)

# What became of a statement of the outbox: its place there, the result, and when it came.
STATEMENT_OUTCOMES = T.StructType(
    [
        T.StructField("planned_run", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("snowflake_role", T.StringType()),
        T.StructField("snowflake_database", T.StringType()),
        T.StructField("snowflake_schema", T.StringType()),
        T.StructField("stmt_no", T.IntegerType()),
        T.StructField("statement", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("errno", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)

GRANTS = T.StructType(
    [
        T.StructField("snowflake_role", T.StringType(), False),
        T.StructField("snowflake_database", T.StringType(), False),
        T.StructField("snowflake_schema", T.StringType(), False),
        T.StructField("latest_action_request_urn", T.StringType(), False),
        T.StructField("requestor_email", T.StringType()),
        T.StructField("granted_at", T.TimestampType(), False),
        T.StructField("expires_at", T.TimestampType()),
        T.StructField("revoked_at", T.TimestampType()),
    ]
)

SLA_NOTIFICATIONS = T.StructType(
    [
        T.StructField("action_request_urn", T.StringType(), False),
        T.StructField("notification_type", T.StringType(), False),
        T.StructField("sent_at", T.TimestampType(), False),
    ]
)

PROVISIONING_ERRORS = T.StructType(
    [
        T.StructField("action_request_urn", T.StringType(), False),
        T.StructField("snowflake_error_code", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("failed_at", T.TimestampType(), False),
    ]
)

# A request to grant or a grant to revoke whose statements are out: what is known of them so
# far (a bit per statement that succeeded, the first one that failed), and what to record then.
OPEN_UNITS = T.StructType(
    [
        T.StructField("planned_run", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("snowflake_role", T.StringType()),
        T.StructField("snowflake_database", T.StringType()),
        T.StructField("snowflake_schema", T.StringType()),
        T.StructField("statements", T.IntegerType()),
        T.StructField("planned_at", T.TimestampType()),
        T.StructField("ok_bits", T.LongType()),
        T.StructField("failed_stmt", T.IntegerType()),
        T.StructField("errno", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("note", T.StringType()),
        T.StructField("resource", T.StringType()),
        T.StructField("form_role", T.StringType()),
        T.StructField("form_schema", T.StringType()),
        T.StructField("form_email", T.StringType()),
        T.StructField("resolved_email", T.StringType()),
        T.StructField("access_duration_days", T.IntegerType()),
        T.StructField("failed", T.BooleanType()),
        T.StructField("granted_at", T.TimestampType()),
        T.StructField("expires_at", T.TimestampType()),
    ]
)

DENIALS = T.StructType([T.StructField("urn", T.StringType())])

# One row per change of a grant; the table of grants is the latest row per key.
JOURNAL = T.StructType(
    [
        T.StructField("snowflake_role", T.StringType()),
        T.StructField("snowflake_database", T.StringType()),
        T.StructField("snowflake_schema", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("requestor_email", T.StringType()),
        T.StructField("granted_at", T.TimestampType()),
        T.StructField("expires_at", T.TimestampType()),
        T.StructField("revoked_at", T.TimestampType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("phase", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("dry_run", T.BooleanType()),
        # The run that planned the change, where another one recorded it.
        T.StructField("planned_run", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

STATEMENTS = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("snowflake_role", T.StringType()),
        T.StructField("snowflake_database", T.StringType()),
        T.StructField("snowflake_schema", T.StringType()),
        T.StructField("stmt_no", T.IntegerType()),
        T.StructField("statement", T.StringType()),
        T.StructField("dry_run", T.BooleanType()),
    ]
)

NOTIFICATIONS = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("to", T.ArrayType(T.StringType())),
        T.StructField("cc", T.ArrayType(T.StringType())),
        T.StructField("subject", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        T.StructField("deliverable", T.BooleanType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("urn", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("decision", T.StringType()),
        T.StructField("requests", T.LongType()),
        T.StructField("statements", T.LongType()),
    ]
)

FORM_SPECS = T.StructType(
    [
        T.StructField("workflow", T.StringType()),
        T.StructField("field_id", T.StringType()),
        T.StructField("value_type", T.StringType()),
        T.StructField("cardinality", T.StringType()),
        T.StructField("required", T.BooleanType()),
        T.StructField("allowed_values", T.ArrayType(T.StringType())),
    ]
)
