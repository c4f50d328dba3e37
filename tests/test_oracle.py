"""Every registered query against its SQL."""

from pathlib import Path

import duckdb
import pytest
from helpers import rows

import __spark_entry__ as entry

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES = {n: f for n, f in entry.queries().items() if f.__module__ == entry.__name__}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    described = con.execute("describe " + ORACLE[name]).fetchall()
    assert {d[0]: d[1] for d in described} == {n: TYPES[t] for n, t in result.dtypes}
    ordered = con.execute(
        "select " + ", ".join(f'"{c}"' for c in columns) + f" from ({ORACLE[name]})"
    ).fetchall()
    got = rows(result.select(*columns))
    assert got and got == sorted(ordered, key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
