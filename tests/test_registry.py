"""Every registered query: whole result equal to its SQL, and a plan fit for scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as repo
from checks.compare import connection, differences, spark_rows, sql_rows
from checks.oracle import oracle_sql as own_sql
from checks.queries import queries as own_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = own_queries(), own_sql()

SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db():
    return connection(FOLDER)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_match():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(repo.queries()) and set(SQL) <= set(repo.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert word not in plan, plan
    names, rows = spark_rows(df)
    if name in SQL:
        expected_names, expected = sql_rows(db, SQL[name])
        assert names == expected_names
        types = {n: SQL_TYPES[t] for n, t in df.dtypes}
        assert types == {r[0]: r[1] for r in db.execute("DESCRIBE " + SQL[name]).fetchall()}
        assert differences(rows, expected) == []


def test_entry(spark):
    assert repo.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["category_summary_clicks"](spark, FOLDER))
    assert "EqualTo(event_type,purchase)" in plan or "In(event_type, [purchase])" in plan
    exact = plan_of(QUERIES["view_exact_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in exact and "LessThan(o_orderdate" in exact
    days = plan_of(QUERIES["daily_revenue"](spark, FOLDER))
    assert "l_shipdate" not in days and "part.parquet" not in days
    for name in ("view_categories_staged", "view_kpis"):
        assert re.search(r"PartitionFilters: \[.*month", plan_of(QUERIES[name](spark, FOLDER))), name
    for name in ("product_abc", "top_products_quantity", "pareto_summary"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, FOLDER)), name
