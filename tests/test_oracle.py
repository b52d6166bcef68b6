"""Every registered query with SQL against DuckDB on the small tables; the others run and keep their schema."""

import os

import duckdb
import pytest

import chunkloom.oracle as oracle
from chunkloom.queries import QUERIES
from tests.conftest import SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.split('.')[0]} as select * from read_parquet('{SF}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got
    if name in oracle.ORACLE:
        found = duck.sql(oracle.ORACLE[name])
        assert sorted(found.columns) == columns
        place = [found.columns.index(c) for c in columns]
        assert got == sorted((tuple(plain(r[i]) for i in place) for r in found.fetchall()), key=str)
