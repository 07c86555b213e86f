"""Every registered query against its SQL text, on the smallest scale."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from faremill import oracle
from faremill import queries as registry

QUERIES, ORACLE = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def test_names_line_up():
    assert set(ORACLE) == set(QUERIES)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(TESTDATA))
    columns = sorted(frame.columns)
    found = sorted(repr([row[c] for c in columns]) for row in frame.collect())
    answer = duck.execute(ORACLE[name])
    names = [item[0] for item in answer.description]
    assert columns == sorted(names)
    places = [names.index(c) for c in columns]
    assert found == sorted(repr([row[i] for i in places]) for row in answer.fetchall())
