from pyspark.sql import functions as F

from grantline.functions import statements


def run(spark, build, role="ANALYST", database="PROD", schema="SALES"):
    frame = spark.createDataFrame(
        [(role, database, schema)], "r string, d string, s string"
    )
    return frame.select(build(F.col("r"), F.col("d"), F.col("s")).alias("x")).first().x


GRANTS = [
    "GRANT USAGE ON DATABASE PROD TO ROLE ANALYST",
    "GRANT USAGE ON SCHEMA PROD.SALES TO ROLE ANALYST",
    "GRANT SELECT ON ALL TABLES IN SCHEMA PROD.SALES TO ROLE ANALYST",
    "GRANT SELECT ON FUTURE TABLES IN SCHEMA PROD.SALES TO ROLE ANALYST",
]
ALL = [
    "GRANT USAGE ON DATABASE PROD TO ROLE ANALYST",
    "GRANT USAGE ON ALL SCHEMAS IN DATABASE PROD TO ROLE ANALYST",
    "GRANT USAGE ON FUTURE SCHEMAS IN DATABASE PROD TO ROLE ANALYST",
]
WAREHOUSE = "GRANT USAGE ON WAREHOUSE COMPUTE_WH TO ROLE ANALYST"


def test_grant_with_schema(spark):
    assert run(spark, statements.grant_statements) == GRANTS


def test_grant_with_warehouse(spark):
    def build(r, d, s):
        return statements.grant_statements(r, d, s, "COMPUTE_WH")

    assert run(spark, build) == [*GRANTS, WAREHOUSE]
    assert run(spark, build, schema=None) == [*ALL, WAREHOUSE]


def test_grant_without_schema(spark):
    assert run(spark, statements.grant_statements, schema=None) == ALL
    assert run(spark, statements.grant_statements, schema="") == ALL


def test_one_reported_line_stands_for_both_table_grants(spark):
    assert run(spark, statements.grant_report) == [
        *GRANTS[:2],
        "GRANT SELECT ON ALL/FUTURE TABLES IN SCHEMA PROD.SALES TO ROLE ANALYST",
    ]
    assert run(spark, statements.grant_report, schema=None) == ALL


def test_revoke(spark):
    assert run(spark, statements.revoke_statements) == [
        "REVOKE SELECT ON ALL TABLES IN SCHEMA PROD.SALES FROM ROLE ANALYST",
        "REVOKE SELECT ON FUTURE TABLES IN SCHEMA PROD.SALES FROM ROLE ANALYST",
        "REVOKE USAGE ON SCHEMA PROD.SALES FROM ROLE ANALYST",
        "REVOKE USAGE ON DATABASE PROD FROM ROLE ANALYST",
    ]
    only = ["REVOKE USAGE ON DATABASE PROD FROM ROLE ANALYST"]
    assert run(spark, statements.revoke_statements, schema=None) == only
    assert run(spark, statements.revoke_report, schema="") == only
    assert run(spark, statements.revoke_report)[0] == (
        "REVOKE SELECT ON ALL/FUTURE TABLES IN SCHEMA PROD.SALES FROM ROLE ANALYST"
    )


def test_role_grant(spark):
    found = run(spark, lambda r, d, s: statements.role_grant_statement(r, d))
    assert found == "GRANT ROLE ANALYST TO ROLE PROD"
