import math
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from salesloom.operators import aggregates as agg
from salesloom.plans.marts import largest

NAN = float("nan")


@pytest.fixture(scope="module")
def micro(spark):
    rows = [("a", None), ("b", NAN), ("b", 2.0), (None, 9.0)]
    return spark.createDataFrame(rows, "k string, v double")


def test_missing_keys_and_values(micro):
    assert rows_of(agg.total_by(micro, "k", "v")) == [("a", 0.0), ("b", 2.0)]
    assert rows_of(agg.average_by(micro, "k", "v")) == [("a", None), ("b", 2.0)]
    parts = agg.partial_sums(micro, ["k"], "v")
    assert rows_of(agg.average_of_parts(parts, "k", "v")) == [("a", None), ("b", 2.0)]
    assert rows_of(agg.total_by(parts, "k", "v_sum", "v")) == [("a", 0.0), ("b", 2.0)]


def test_money_sum_is_exact_and_order_free(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(0.1).alias("v"))
    assert agg.total_by(df, "k", "v").first()["v"] == 100.0
    shuffled = df.repartition(7)
    assert agg.average_by(shuffled, "k", "v").first()["v"] == 0.1


@pytest.mark.parametrize("bad", [math.inf, -math.inf, 1e300])
def test_amount_that_does_not_fit_raises(spark, bad):
    df = spark.createDataFrame([("a", bad)], "k string, v double")
    with pytest.raises(Exception, match="too large"):
        agg.total_by(df, "k", "v").collect()


def test_signs_limits_and_types(spark):
    rows = [("a", -0.01), ("a", -1234567.89), ("a", 1e13), ("b", 8.9e13), ("b", 8.9e13), ("c", -0.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    parts = agg.partial_sums(df, ["k"], "v")
    assert parts.schema["v_sum"].dataType.simpleString() == "decimal(38,20)"
    got = {r["k"]: r["v_sum"] for r in parts.collect()}
    assert got == {
        "a": Decimal("9999998765432.1000"), "b": Decimal("178000000000000"), "c": Decimal(0),
    }
    floats = df.withColumn("v", F.col("v").cast("float"))
    assert {r["k"] for r in agg.total_by(floats, "k", "v").collect()} == {"a", "b", "c"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_total_that_does_not_fit_raises(spark, ansi):
    # 2**23 amounts near the limit exceed the high part's long.
    df = spark.range(2**24, numPartitions=4).select(F.lit("k").alias("k"), F.lit(8.9e13).alias("v"))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="total too large"):
            agg.total_by(df, "k", "v").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_whole_numbers_stay_whole(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int")
    got = agg.total_by(df, "k", "v")
    assert got.schema["v"].dataType.simpleString() == "bigint"
    assert rows_of(got) == [("a", 3), ("b", 0)]
    assert rows_of(agg.average_by(df, "k", "v")) == [("a", 1.5), ("b", None)]


def test_ties_keep_the_lower_key(spark):
    df = spark.createDataFrame([(k, 5) for k in (9, 3, 7, 1, 8, 2)] + [(6, 6)], "k int, v int")
    assert [r["k"] for r in agg.top_k(df, "k", "v").collect()] == [6, 1, 2, 3, 7]
    assert "TakeOrderedAndProject" in _plan(largest(df, "k", "v"))


def test_fewer_groups_than_k(spark):
    df = spark.createDataFrame([(2, 1), (1, 1)], "k int, v int")
    assert [tuple(r) for r in agg.top_k(df, "k", "v").collect()] == [(1, 1), (2, 1)]


def test_preview_and_present(spark):
    df = spark.createDataFrame([(k, "x") for k in (4, 2, 3, 1)], "`a.k` int, v string")
    assert [r[0] for r in agg.present(df, "a.k").collect()] == [1, 2, 3, 4]
    assert [r[0] for r in agg.preview(df, "a.k", n=2).collect()] == [1, 2]


def test_sums_are_partial_before_the_shuffle(micro):
    plan = _plan(agg.total_by(micro, "k", "v"))
    assert "partial_sum" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_digit_of_an_amount_is_dropped(spark):
    def total(rows):
        return agg.total_by(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()[0].v

    assert total([("a", 0.00004)] * 100_000) == 4.0
    assert total([("a", 0.00012345), ("a", -0.00002345)]) == 0.0001
    assert total([("a", 0.1), ("a", 1e-7), ("a", -0.1)]) == 1e-7
    assert total([("a", 12.34), ("a", None), ("a", float("nan"))]) == 12.34
    frame = spark.createDataFrame([("a", 0.00004), ("a", 0.00002)], "k string, v double")
    assert agg.average_by(frame, "k", "v").collect()[0].v == 0.00003
    with pytest.raises(Exception, match="too many digits"):
        total([("a", 1.234567e-19)])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_that_do_not_fit_stop_the_job(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        whole = spark.createDataFrame([("a", 2**62), ("a", 2**62)], "k string, v long")
        with pytest.raises(Exception, match="total too large"):
            agg.total_by(whole, "k", "v").collect()
        assert agg.total_by(whole.limit(1), "k", "v").collect()[0].v == 2**62
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
