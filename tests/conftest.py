import pytest
from pyspark.sql import SparkSession

from salesloom.sources.files import from_records
from salesloom.sources.schemas import SALES
from pyspark.sql.types import LongType, StringType, StructField, StructType


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("salesloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "scratch"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


USERS = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("address.city", StringType()),
    ]
)
WEATHER = StructType(
    [StructField("user_info_table_id", LongType()), StructField("weather_main", StringType())]
)


@pytest.fixture(scope="session")
def users(spark):
    rows = [
        (1, "Ann", "Rome"),
        (2, "Bob", "Oslo"),
        (3, "Ann", "Oslo"),
        (4, "Dee", "Lima"),
        (5, None, "Rome"),
        (6, "Eve", None),
    ]
    return from_records(spark, rows, USERS)


@pytest.fixture(scope="session")
def weather(spark):
    rows = [(1, "Clear"), (2, "Rain"), (4, "Clouds"), (6, "Clear"), (99, "Snow")]
    return from_records(spark, rows, WEATHER)


SALES_ROWS = [
    (101, 1, 10, 3, 10.0, "2023-01-31"),
    (102, 1, 11, 5, 20.5, "2023-02-01"),
    (103, 2, 10, 2, 5.25, "2023-03-31"),
    (104, 3, 12, 5, 30.0, "2023-04-01"),
    (105, 3, 13, 5, 1.0, "2023-04-01"),
    (106, 7, 10, 100, 999.0, "2023-04-02"),
    (107, 5, 14, 1, 7.75, "2023-06-30"),
    (108, 6, 15, 5, 2.0, "2023-07-01"),
    (109, 2, 16, 1, None, "2023-07-02"),
    (110, 1, 12, None, 4.0, "2023-07-02"),
    (101, 2, 13, 3, 8.0, "2023-12-31"),
    (111, 6, 17, 5, 3.0, "2023-07-01"),
    (112, 6, 18, None, 1.0, None),
]


@pytest.fixture(scope="session")
def sales(spark):
    return from_records(spark, SALES_ROWS, SALES)


def rows_of(df):
    """Rows as a sorted list of tuples; NULLs first."""
    return sorted(
        (tuple(r) for r in df.collect()),
        key=lambda t: [(v is not None, str(type(v)), v) for v in t],
    )
