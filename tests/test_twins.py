"""Every query with a SQL twin gives the same columns, types and values as DuckDB.

``TABLES_DIR`` names another folder of tables to run the twins on.
"""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, TWINS = entry.queries(), entry.oracle_sql()
FOLDER = os.environ.get("TABLES_DIR", SMALL)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(table):
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    return names, types, sorted(map(repr, zip(*[table[n].to_pylist() for n in names])))


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    ours = canonical(df.toArrow())
    theirs = canonical(duck.sql(TWINS[name]).to_arrow_table())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[2] == theirs[2]
    assert ours[2]
    # No plan forms all pairs, and Python runs on Arrow batches only.
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1678
    assert df.columns == ["city", "year", "month", "day", "date", "mean", "lag", "delta"]
