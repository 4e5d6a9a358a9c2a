"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks.compare import differences, oracle_connection
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = os.environ.get("ROSTER_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not here")


@pytest.fixture(autouse=True, scope="module")
def compiled_plans(spark):
    settings = {
        "spark.sql.codegen.wholeStage": "true",
        "spark.sql.codegen.factoryMode": "FALLBACK",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    rows, problem = differences(df, connection, ORACLE_SQL[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
