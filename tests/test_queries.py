"""Every registered query against its SQL in DuckDB, and the plans of the main ones."""

import duckdb
import pytest
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

import __spark_entry__ as entry
from loadkit.queries import ORACLES, QUERIES
from tests.conftest import DATA, SMALL, plan

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def same_rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([v[i] for i in order]) for v in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = [tuple(r) for r in df.collect()]
    assert result
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert same_rows(df.columns, result) == same_rows(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans_and_no_nested_loops(spark, name, monkeypatch):
    """Of the result's plan, and of every frame written on the way to it."""
    plans = []
    for method in ("insertInto", "saveAsTable", "parquet", "save"):
        inner = getattr(DataFrameWriter, method)

        def noted(self, *args, inner=inner, **more):
            plans.append(plan(self._df))
            return inner(self, *args, **more)

        monkeypatch.setattr(DataFrameWriter, method, noted)
    statement = SparkSession.sql

    def stated(self, text, args=None, **frames):
        if text.startswith("INSERT"):
            plans.extend(plan(f) for f in frames.values() if isinstance(f, DataFrame))
        return statement(self, text, args, **frames)

    monkeypatch.setattr(SparkSession, "sql", stated)
    plans.append(plan(QUERIES[name](spark, SMALL)))
    if name.startswith(("sink_", "load_", "sql_batch", "read_dated", "gate_", "merge_into", "insert_only")):
        assert len(plans) > 1
    for text in plans:
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["where_clause"](spark, DATA))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity), EqualTo(l_returnflag,R)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in text
    summary = plan(QUERIES["validation_summary"](spark, DATA))
    assert summary.count("FileScan") == 1
    assert "o_custkey" not in summary and "o_orderdate" not in summary
