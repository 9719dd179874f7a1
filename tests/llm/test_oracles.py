"""The text operators that SQL can express, next to their SQL in DuckDB."""

import pytest

import oracle
from tidelog.llm import catalog

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query(spark, name):
    ours = catalog.QUERIES[name](spark, DATA).toPandas()
    assert oracle.difference(ours, oracle.database(DATA).execute(catalog.ORACLES[name]).df()) is None
