"""Every registered query against its SQL, on whole tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from oracle_check import connection, spark_rows, sql_rows
from tidegauge.plans.oracle import ORACLE
from tidegauge.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

SPARK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
}


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    described = con.execute(ORACLE[name]).description
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {d[0]: SPARK_TYPES[str(d[1])] for d in described}
    names, got = spark_rows(df)
    assert (names, got) == sql_rows(con, ORACLE[name])
    assert got


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r.stage for r in rows] == ["Stage 1", "Stage 2", "Stage 3", "Stage 4"]
