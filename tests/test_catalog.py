"""Every registered query against its SQL equivalent, over whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from textwarden.plans.catalog import QUERIES
from textwarden.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6) + 0.0
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    result = tables.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
