import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from salesloom.operators import joins
from salesloom.sources.files import read_query


def test_wide_table_follows_the_sql_join(spark, sales, users, weather):
    wide = joins.enrich_sales(sales, users, weather)
    expected = read_query(
        spark,
        """select s.*, w.*, u.* from {s} s join {u} u on s.customer_id = u.id
           left join {w} w on w.user_info_table_id = u.id""",
        s=sales,
        u=users,
        w=weather,
    )
    assert wide.columns == sales.columns + weather.columns + users.columns
    assert rows_of(wide) == rows_of(expected)
    assert wide.count() == 12
    assert wide.where("weather_main is null").count() == 3
    assert wide.where("order_id = 106 or id = 4 or weather_main = 'Snow'").count() == 0


def test_every_user_once_with_or_without_weather(users, weather):
    got = joins.users_with_weather(users, weather)
    assert got.columns == weather.columns + users.columns
    assert {(r["id"], r["weather_main"]) for r in got.collect()} == {
        (1, "Clear"), (2, "Rain"), (3, None), (4, "Clouds"), (5, None), (6, "Clear"),
    }


def test_repeated_weather_key_raises(sales, users, weather):
    twice = weather.unionAll(weather.limit(1))
    with pytest.raises(ValueError, match="repeated key"):
        joins.enrich_sales(sales, users, twice)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on key 7 (half of them exact copies), a fourth on NULL."""
    n = 6000
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 4 == 1, F.lit(None))
        .otherwise(F.col("id") % 50)
        .cast("long")
    )
    return spark.range(n, numPartitions=6).select(
        key.alias("k"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("v")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_all_three_ways_give_the_same_rows(spark, hot, how):
    reference = spark.range(40).select(
        F.col("id").alias("rk"), F.concat(F.lit("n"), F.col("id")).alias("label")
    ).unionAll(spark.sql("select 3L, 'again'"))
    expected = rows_of(hot.join(reference, F.col("k") == F.col("rk"), how))
    on = [("k", "rk")]
    auto = joins.lookup_join(hot, reference, on, how)
    split = joins.lookup_join(hot, reference, on, how, broadcast_limit=0, hot_bytes=10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = joins.lookup_join(hot, reference, on, how)
        assert "BroadcastHashJoin" in plan_of(hinted)
        plain = joins.lookup_join(hot, reference, on, how, broadcast_limit=0)
        assert "_fact_salt" not in plan_of(plain)
        assert rows_of(hinted) == expected
        assert rows_of(plain) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_fact_salt" in plan_of(split)
    assert rows_of(auto) == expected
    assert rows_of(split) == expected


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_hot_key_is_found_and_spread(spark, hot):
    found = joins.hot_keys(hot, ["k"], hot_bytes=10_000)
    seven = spark.sql("select xxhash64(7L)").first()[0]
    null = spark.sql("select xxhash64(cast(null as bigint))").first()[0]
    assert {r["_hot"] for r in found.collect()} == {seven, null}
    reference = spark.range(40).select(F.col("id").alias("rk"))
    salted = joins._salted_join(hot, reference, [("k", "rk")], "inner", found)
    assert salted.where("k = 7").count() == hot.where("k = 7").count()


def test_all_hot_keys_are_split_by_their_own_size(spark):
    """Two thousand hot keys and one that is much hotter; barely hot ones get two copies."""
    facts = spark.range(2000 * 12, numPartitions=6).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    facts = facts.union(spark.range(3000).select(F.lit(5).cast("long").alias("k"), F.col("id").alias("v")))
    hot = joins.hot_keys(facts, ["k"], hot_bytes=10 * 32).collect()
    assert len(hot) == 2000
    salts = sorted(r["_salts"] for r in hot)
    assert salts[:-1] == [2] * 1999 and salts[-1] == 302
    reference = spark.range(2500).select(F.col("id").alias("rk"))
    got = joins.lookup_join(facts, reference, [("k", "rk")], broadcast_limit=0, hot_bytes=320)
    assert got.count() == facts.count()


def test_rows_of_one_partition_and_copies_spread(spark):
    one = spark.range(1000, numPartitions=1).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    assert one.select(joins.salt(one, F.lit(16))).distinct().count() == 16
    copies = spark.range(400, numPartitions=40).select(F.lit(7).alias("k"))
    assert copies.select(joins.salt(copies, F.lit(4))).distinct().count() == 4
    again = [r[0] for r in one.select(joins.salt(one, F.lit(16))).collect()]
    assert again == [r[0] for r in one.select(joins.salt(one, F.lit(16))).collect()]


def test_hot_keys_of_another_frame(spark, hot):
    reference = spark.range(40).select(F.col("id").alias("rk"))
    got = joins.lookup_join(
        hot, reference, [("k", "rk")], broadcast_limit=0, hot_bytes=10_000,
        keys_from=hot.select("k").where("k = 7 or k = 8"),
    )
    assert "_fact_salt" in plan_of(got)
    assert rows_of(got) == rows_of(hot.join(reference, F.col("k") == F.col("rk")))


def test_small_tables_have_no_hot_keys(hot):
    assert joins.hot_keys(hot, ["k"]).count() == 0


@pytest.mark.parametrize(
    "text, size",
    [("-1", -1), ("10485760b", 10 * joins.MIB), ("10MB", 10 * joins.MIB), ("2g", 2**31)],
)
def test_broadcast_threshold(spark, text, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
    try:
        assert joins._auto_broadcast_bytes(spark) == size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_size_counts_all_text(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert joins.measured_bytes(df) == 10 * (16 + 2 * 8) + 1000
    assert joins.measured_bytes(df.limit(0)) == 0
    assert joins.measured_bytes(df.select(F.col("t").cast("binary"))) == 10 * 24 + 1000
    nested = df.select(F.array("t", "t").alias("a"))
    assert joins.measured_bytes(nested) > 2000


def test_key_types_and_names_are_checked(spark, sales, users):
    with pytest.raises(ValueError, match="key types differ"):
        joins.lookup_join(sales, users, [("customer_id", "name")])
    with pytest.raises(ValueError, match="both sides"):
        joins.lookup_join(sales, sales, [("customer_id", "customer_id")])


def plain_hot_keys(df, hot_bytes, row_bytes):
    """All keys added up one by one."""
    per_key = df.groupBy(F.xxhash64("k").alias("h")).agg(F.sum(row_bytes).alias("b")).where(F.col("b") > hot_bytes)
    return sorted((r.h, -(-r.b // hot_bytes)) for r in per_key.collect())


@pytest.mark.parametrize("seed, hot_bytes", [(1, 500), (2, 3000), (3, 100_000), (4, 1 << 40)])
def test_histogram_finds_the_hot_keys_of_a_plain_sum(spark, seed, hot_bytes):
    rng = random.Random(seed)
    rows = [(int(rng.paretovariate(0.8)), "x" * rng.randrange(50)) for _ in range(3000)]
    rows += [(None, "null key")] * 40
    df = spark.createDataFrame(rows, "k long, text string").repartition(5)
    size = joins._row_bytes(df)
    for cells in (1, 7, 1 << 12):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(joins, "_cells", lambda *a: cells)
            got = joins.hot_keys(df, ["k"], hot_bytes)
            assert sorted(map(tuple, got.collect())) == plain_hot_keys(df, hot_bytes, size)


def test_histogram_shuffles_cells_and_not_keys(spark, tmp_path):
    """Two million keys: each task passes on a row per cell at most."""
    keys = spark.range(2_000_000, numPartitions=8).select(F.col("id").alias("k"))
    cells = joins._cells(keys, joins.HOT_BYTES)
    assert cells * 8 < 0.01 * 2_000_000
    assert joins.hot_keys(keys, ["k"]).count() == 0
    assert joins.hot_keys(keys, ["k"]).schema.simpleString() == "struct<_hot:bigint,_salts:int>"
