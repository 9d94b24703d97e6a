"""Texts of GRANT and REVOKE statements, as ``array<string>`` columns. Names go unquoted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantline.functions.identity import non_empty
from grantline.functions.text import fill


# The statements the target warehouse understands.
GRANT_DATABASE = "GRANT USAGE ON DATABASE {d} TO ROLE {r}"
GRANT_SCHEMA = "GRANT USAGE ON SCHEMA {d}.{s} TO ROLE {r}"
GRANT_ALL_TABLES = "GRANT SELECT ON ALL TABLES IN SCHEMA {d}.{s} TO ROLE {r}"
GRANT_FUTURE_TABLES = "GRANT SELECT ON FUTURE TABLES IN SCHEMA {d}.{s} TO ROLE {r}"
GRANT_TABLES_REPORTED = "GRANT SELECT ON ALL/FUTURE TABLES IN SCHEMA {d}.{s} TO ROLE {r}"
GRANT_ALL_SCHEMAS = "GRANT USAGE ON ALL SCHEMAS IN DATABASE {d} TO ROLE {r}"
GRANT_FUTURE_SCHEMAS = "GRANT USAGE ON FUTURE SCHEMAS IN DATABASE {d} TO ROLE {r}"
GRANT_WAREHOUSE = "GRANT USAGE ON WAREHOUSE {w} TO ROLE {r}"
GRANT_ROLE = "GRANT ROLE {a} TO ROLE {b}"
REVOKE_ALL_TABLES = "REVOKE SELECT ON ALL TABLES IN SCHEMA {d}.{s} FROM ROLE {r}"
REVOKE_FUTURE_TABLES = "REVOKE SELECT ON FUTURE TABLES IN SCHEMA {d}.{s} FROM ROLE {r}"
REVOKE_TABLES_REPORTED = "REVOKE SELECT ON ALL/FUTURE TABLES IN SCHEMA {d}.{s} FROM ROLE {r}"
REVOKE_SCHEMA = "REVOKE USAGE ON SCHEMA {d}.{s} FROM ROLE {r}"
REVOKE_DATABASE = "REVOKE USAGE ON DATABASE {d} FROM ROLE {r}"


def _branch(
    role: Column,
    database: Column,
    schema: Column,
    with_schema: list[str],
    without_schema: list[str],
) -> Column:
    parts = {"d": database, "s": schema, "r": role}
    return F.when(
        non_empty(schema).isNotNull(), F.array(*[fill(t, **parts) for t in with_schema])
    ).otherwise(F.array(*[fill(t, **parts) for t in without_schema]))


def _with_warehouse(statements: Column, role: Column, warehouse: str | None) -> Column:
    if not warehouse:
        return statements
    extra = fill(GRANT_WAREHOUSE, w=F.lit(warehouse), r=role)
    return F.concat(statements, F.array(extra))


def grant_statements(
    role: Column, database: Column, schema: Column, warehouse: str | None = None
) -> Column:
    """Statements to execute: 4 with a schema, 3 without, one more for a warehouse."""
    plan = _branch(
        role,
        database,
        schema,
        [GRANT_DATABASE, GRANT_SCHEMA, GRANT_ALL_TABLES, GRANT_FUTURE_TABLES],
        [GRANT_DATABASE, GRANT_ALL_SCHEMAS, GRANT_FUTURE_SCHEMAS],
    )
    return _with_warehouse(plan, role, warehouse)


def grant_report(
    role: Column, database: Column, schema: Column, warehouse: str | None = None
) -> Column:
    """Lines reported to the requestor; one stands for both table grants."""
    plan = _branch(
        role,
        database,
        schema,
        [GRANT_DATABASE, GRANT_SCHEMA, GRANT_TABLES_REPORTED],
        [GRANT_DATABASE, GRANT_ALL_SCHEMAS, GRANT_FUTURE_SCHEMAS],
    )
    return _with_warehouse(plan, role, warehouse)


def revoke_statements(role: Column, database: Column, schema: Column) -> Column:
    """Statements to execute on expiry. Warehouse and all-schema usage stay granted."""
    return _branch(
        role,
        database,
        schema,
        [REVOKE_ALL_TABLES, REVOKE_FUTURE_TABLES, REVOKE_SCHEMA, REVOKE_DATABASE],
        [REVOKE_DATABASE],
    )


def revoke_report(role: Column, database: Column, schema: Column) -> Column:
    return _branch(
        role,
        database,
        schema,
        [REVOKE_TABLES_REPORTED, REVOKE_SCHEMA, REVOKE_DATABASE],
        [REVOKE_DATABASE],
    )


def role_grant_statement(target_role: Column, grantee_role: Column) -> Column:
    return fill(GRANT_ROLE, a=target_role, b=grantee_role)
