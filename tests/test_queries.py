"""Every registered query against its SQL, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from changeflow.operators import blocks
from changeflow.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(autouse=True)
def many_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "ROWS_A_BLOCK", 100)


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(plain(x) for x in v) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are missing")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    rel = duck.sql(catalogue.ORACLES[name])
    assert sorted(rel.columns) == columns
    place = [rel.columns.index(c) for c in columns]
    assert found == sorted((tuple(plain(r[i]) for i in place) for r in rel.fetchall()), key=repr)


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(SF):
        assert entry.entry(spark).count() > 0
