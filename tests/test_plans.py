"""What the plans of the registered queries must keep: narrow scans, early sums, no wide windows."""

import os
import re

import pytest

import __spark_entry__ as contract
from salesloom.plans import star_schema

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text, table):
    """Columns read from ``table``."""
    for line in text.splitlines():
        if "FileScan" in line and f"/{table}.parquet" in line:
            columns = re.search(r"FileScan parquet \[(.*?)\]", line).group(1)
            return {c.split("#")[0] for c in columns.split(",")}
    raise LookupError(table)


def test_totals_read_two_columns_and_sum_before_the_join(spark):
    text = plan(spark, "total_sales_per_customer")
    assert scanned(text, "lineitem") == {"l_orderkey", "l_extendedprice"}
    assert scanned(text, "orders") == {"o_orderkey", "o_custkey"}
    assert scanned(text, "customer") == {"c_custkey", "c_name", "c_nationkey"}
    lines = text.splitlines()
    users = next(i for i, line in enumerate(lines) if "c_name" in line and "FileScan" in line)
    early = [i for i, line in enumerate(lines) if "keys=[customer_id" in line and "partial" in line]
    assert early and early[0] < users


def test_daily_totals_test_customers_before_the_lines(spark):
    text = plan(spark, "sales_trends_daily")
    assert scanned(text, "lineitem") == {"l_orderkey", "l_extendedprice"}
    assert scanned(text, "customer") == {"c_custkey", "c_nationkey"}
    semi = text.index("LeftSemi")
    assert text.index("o_orderkey#") < semi


def test_missing_keys_are_dropped_at_the_scan(spark):
    text = plan(spark, "top_selling_products")
    assert "isnotnull(l_partkey" in text
    assert "TakeOrderedAndProject" in text


def test_payload_text_is_parsed_once(spark):
    text = plan(spark, "extract_payload")
    extraction = text[: text.index("Generate")]
    assert "from_json" not in extraction


@pytest.mark.parametrize("name", sorted(star_schema.QUERIES))
def test_no_window_and_no_cross_product(spark, name):
    text = plan(spark, name)
    assert "Window" not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
