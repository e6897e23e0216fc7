"""Sums of any doubles against math.fsum, which rounds the true sum once."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from salesloom.operators.float_sums import finish_parts, float_parts, float_totals, merge_parts

INF, NAN = math.inf, math.nan


def any_double(rng):
    while True:
        (x,) = struct.unpack("d", rng.randbytes(8))
        if math.isfinite(x) and abs(x) < 1e300:
            return x


KINDS = {
    "any bits": any_double,
    "amounts": lambda rng: round(rng.uniform(-1e5, 1e5), 2),
    "thirds": lambda rng: rng.uniform(-1, 1) / 3e5,
    "cancelling": lambda rng: rng.choice([1e16, -1e16, 1.0, 1e-16, -1.0, 3.0]),
    "tiny": lambda rng: rng.choice([5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, 3e-320]),
    "ties": lambda rng: rng.choice([2.0**53, 1.0, -1.0, 2.0**-40, 2.0**52, 0.5]),
    "powers": lambda rng: rng.choice([-1, 1]) * 2.0 ** rng.randrange(-1074, 990),
}


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or (a == b)


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_equals_fsum(spark, kind):
    rng = random.Random(kind)
    rows = [(k, KINDS[kind](rng)) for k in range(60) for _ in range(rng.randrange(1, 30))]
    frame = spark.createDataFrame(rows, "k int, v double")
    for parts in (1, 7):
        got = {r.k: r.total for r in float_totals(frame.repartition(parts), "k", "v").collect()}
        want = {k: math.fsum(v for j, v in rows if j == k) for k in range(60)}
        assert got == want


def test_missing_infinite_and_zero(spark):
    rows = [("a", None), ("a", NAN), ("b", INF), ("b", 1.0), ("c", INF), ("c", -INF), ("d", -0.0), ("e", -INF),
            (None, 3.0), ("f", 1e308), ("f", 1e308), ("g", 1e308), ("g", 1e308), ("g", -1e308), ("h", NAN), ("h", 2.5)]
    got = {r.k: (r.total, r.mean) for r in float_totals(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    want = {"a": (0.0, None), "b": (INF, INF), "c": (NAN, NAN), "d": (0.0, 0.0), "e": (-INF, -INF),
            "f": (INF, INF), "g": (1e308, 1e308 / 3), "h": (2.5, 2.5)}
    assert got.keys() == want.keys()
    for k, pair in want.items():
        assert all(a is b or same(a, b) for a, b in zip(got[k], pair)), k
    empty = spark.createDataFrame([], "k string, v double")
    assert float_totals(empty, "k", "v").collect() == []


def test_parts_can_be_stored_and_merged(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randrange(4), any_double(rng)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, day int, v double")
    for half in (0, 1):
        some = frame.where(F.col("day") % 2 == half)
        float_parts(some, ["k", "day"], "v").write.mode("append").parquet(str(tmp_path / "parts"))
    merged = merge_parts(spark.read.parquet(str(tmp_path / "parts")), ["k"])
    got = {r.k: r.t for r in finish_parts(merged, ["k"], "t").collect()}
    assert got == {k: math.fsum(v for j, _, v in rows if j == k) for k in "ab"}


def test_a_hot_key_is_one_row_a_task(spark):
    frame = spark.range(50_000, numPartitions=4).selectExpr("'k' k", "0.1 + id v")
    text = float_parts(frame, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2 and "Python" not in text
    got = float_totals(frame, "k", "v").first().total
    assert got == math.fsum(0.1 + i for i in range(50_000))
