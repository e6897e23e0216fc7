"""Every registered query against its SQL, on the driver's tables when they are there."""

import functools
import os

import duckdb
import pytest

import __spark_entry__ as contract
from salesloom.operators import joins, lookup
from salesloom.plans import marts, star_schema, star_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(
        picked, key=lambda t: [(v is not None, v if v is not None else 0) for v in t]
    )


def test_every_query_has_its_sql():
    assert set(star_schema.QUERIES) == set(star_sql.SQL)
    assert set(star_schema.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(star_schema.QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR)
    result = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = canonical(columns, result.fetchall())
    actual = canonical(got.columns, [tuple(r) for r in got.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert len(expected[1]) > 0
    for a, b in zip(actual[1], expected[1]):
        assert [type(v) for v in a] == [type(v) for v in b]
        assert a == b


SPLIT = [
    "sales_enriched",
    "sales_with_users",
    "total_sales_per_customer",
    "average_sales_per_weather",
    "top_selling_products",
    "sales_trends_daily",
    "lookup_enrich",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_agrees_when_every_join_is_split(spark, db, monkeypatch, name):
    """No broadcast at all, and keys of a few rows already count as hot."""
    split = functools.partial(joins.lookup_join, broadcast_limit=0, hot_bytes=100)
    for module in (joins, lookup, marts):
        monkeypatch.setattr(module, "lookup_join", split)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_query_agrees_with_sql(spark, db, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_totals_agree_with_each_other(spark):
    run = contract.queries()
    names = ["total_sales_per_customer", "total_sales_per_city", "sales_trends_daily",
             "sales_trends_monthly", "sales_trends_quarterly"]
    sums = {
        n: run[n](spark, SF_DIR).selectExpr("sum(cast(price as decimal(18,2)))").first()[0]
        for n in names
    }
    assert len(set(sums.values())) == 1
    totals = {tuple(r) for r in run["total_sales_per_customer"](spark, SF_DIR).collect()}
    assert {tuple(r) for r in run["top_selling_customers"](spark, SF_DIR).collect()} <= totals


def test_flagship(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    assert contract.entry(spark).count() > 0
