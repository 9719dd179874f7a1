"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import oracle
import __spark_entry__ as registered
from tidelog.plans import catalog

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return oracle.database(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLES) <= set(registered.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, database, name):
    difference, _ = oracle.compare(spark, database, name, SF_DIR)
    assert difference is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
