"""Registered queries against their SQL oracles at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
import check
from workload.oracles import oracle_sql
from workload.queries import NAMES, queries


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(queries()) - set(oracle_sql()) == {"sample_rows"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf, name):
    line = check.compare(spark, con, name, sf)
    assert not line.startswith("FAIL"), line


def test_entry(spark):
    assert contract.entry(spark).count() > 0
