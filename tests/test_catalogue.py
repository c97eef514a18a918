"""Every query against its SQL text in DuckDB, and rules that all plans keep."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as driver
from featuremart.catalogue import all_oracles, all_queries
from featuremart.catalogue.roles import TABLES

SMALL = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}

# Joins with a calendar or category table of a few rows.
SPINES = {"calendar_spine", "row_numbers"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, "" if v is None else v) for v in r))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def test_every_query_has_a_sql_text():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|MapInPandas|FlatMapGroups|ArrowEvalPython", plan)
    assert name in SPINES or "CartesianProduct" not in plan and "BroadcastNestedLoopJoin Cross" not in plan
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert {n: TYPES[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    ours, theirs = ordered(map(tuple, df.select([f"`{n}`" for n in names]).collect())), ordered(result.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize(
    "name, column",
    [("pay_month_slots", "o_orderdate"), ("pay_block", "o_orderdate"), ("complaint_rollup", "l_shipdate")],
)
def test_window_reaches_the_scan(spark, name, column):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({column}" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["equipment_matrix"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string,l_linestatus:string>" in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0
