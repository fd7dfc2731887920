"""Every catalogue query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from lorebase.plans import catalogue, chains, knowledge  # noqa: F401

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(BASE):
        con.execute(f"create view {f.split('.')[0]} as select * from '{BASE}/{f}'")
    return con


def bag(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(c).to_pylist() for c in names])))


@pytest.mark.skipif(not os.path.isdir(BASE), reason="needs the driver's tables")
@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, sql, name):
    assert bag(catalogue.QUERIES[name](spark, BASE).toArrow()) == bag(sql.sql(catalogue.ORACLES[name]).to_arrow_table())
