import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from salesloom.operators import ordinal
from salesloom.operators.ordinal import with_ordinal
from salesloom.scratch import land
from salesloom.sources.files import read_sales_csv

HEADER = "order_id,customer_id,product_id,quantity,price,order_date"


def test_ordinal_is_the_rank(spark):
    df = spark.range(1000, numPartitions=7).select(((F.col("id") * 37) % 1000).alias("k"))
    got = with_ordinal(df, ["k"], start=1)
    assert got.columns == ["k", "ordinal"]
    assert got.where("ordinal != k + 1").count() == 0
    assert got.count() == 1000


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_key_is_cut_into_several_ranges(spark, no_coalescing, monkeypatch):
    landed = []
    monkeypatch.setattr(ordinal, "land", lambda *a: landed.append(land(*a)) or landed[-1])
    df = spark.range(4000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).alias("k"),
        F.lit("copy").alias("v"),
    )
    got = with_ordinal(df, ["k"])
    numbers = [r["ordinal"] for r in got.select("ordinal").collect()]
    assert sorted(numbers) == list(range(4000))
    wrong = got.alias("a").join(got.alias("b"), F.col("a.ordinal") + 1 == F.col("b.ordinal"))
    assert wrong.where("a.k > b.k").count() == 0
    rows_per_file = [
        r["count"]
        for r in landed[0].where("k = 500").groupBy(F.input_file_name()).count().collect()
    ]
    assert len(rows_per_file) > 1


def test_empty_table(spark):
    assert with_ordinal(spark.range(0), ["id"]).count() == 0


def test_dotted_names(spark):
    df = spark.createDataFrame([("b",), ("a",)], "`x.y` string")
    assert rows_of(with_ordinal(df, ["x.y"])) == [("a", 0), ("b", 1)]


@pytest.fixture
def split_files(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_position_over_files_and_blocks(spark, tmp_path, split_files):
    expected = 0
    for part, rows in enumerate([700, 1, 0, 2000]):
        lines = [HEADER]
        for _ in range(rows):
            lines.append(f"{expected},1,2,3,{expected % 7}.5,2023-01-01")
            expected += 1
        (tmp_path / f"sales-{part}.csv").write_text("\n".join(lines) + "\n")
    got = read_sales_csv(spark, str(tmp_path), with_index=True)
    assert got.columns == ["index", *HEADER.split(",")]
    assert got.where("index != order_id").count() == 0
    assert got.count() == expected
    # The same when a task lands more than one file.
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        got = read_sales_csv(spark, str(tmp_path), with_index=True)
        assert got.where("index != order_id").count() == 0
        assert got.count() == expected
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


@pytest.fixture
def one_row_per_file(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    yield
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_many_files_of_a_task_keep_their_order(spark, tmp_path, one_row_per_file):
    """More than a thousand files: their numbers have three and four digits."""
    text = "\n".join([HEADER, *[f"{i},1,1,1,1.0,2023-01-01" for i in range(1200)]])
    (tmp_path / "sales.csv").write_text(text + "\n")
    got = read_sales_csv(spark, str(tmp_path / "sales.csv"), with_index=True)
    assert got.where("index != order_id").count() == 0 and got.count() == 1200
    ranked = with_ordinal(spark.range(1200, numPartitions=1).coalesce(1), ["id"])
    assert ranked.where("ordinal != id").count() == 0 and ranked.count() == 1200
