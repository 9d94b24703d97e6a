"""Every query against its reference SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks import oracles, queries
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"

# Redelivery to a stream is compared at length elsewhere.
NAMES = [name for name in queries.all_queries() if name != "q79_stream_redelivery"]


@pytest.fixture(scope="module")
def database():
    return connect(SF)


def test_every_query_has_reference_sql():
    assert set(queries.all_queries()) == set(oracles.all_oracles())
    assert set(queries.all_queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, name):
    frame = driver.queries()[name](spark, SF)
    assert difference(frame, database, driver.oracle_sql()[name]) is None


def test_entry_gives_rows(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["urn", "stmt_no", "statement"] and frame.count() > 0
