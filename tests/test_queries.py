"""Every registered query against its checking SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as driver
from strata.plans import registry

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def test_contract_functions(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = driver.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    expected = duck.sql(f"select {', '.join(cols)} from ({sql})")
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == dict(
        zip(expected.columns, map(str, expected.types)))
    assert got == sorted(expected.fetchall(), key=repr)
