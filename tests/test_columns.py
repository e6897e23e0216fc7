import json
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from salesloom.functions.columns import first_element, parse_date, period_start, q
from salesloom.functions.payload import extract_payload
from salesloom.operators.flatten import flatten
from salesloom.sources.schemas import USER, WEATHER_FIELDS

READINGS = {
    "weather": [{"id": 12, "main": "Hail", "description": "small hail", "icon": "h1"}],
    "main": {"temp": 1.5, "feels_like": -0.25, "temp_min": 0.5, "temp_max": 3, "pressure": 900, "humidity": 55},
    "visibility": 4000,
    "wind": {"speed": 9.75, "deg": 45},
    "clouds": {"all": 100},
}
GOOD = json.dumps(READINGS, separators=(",", ":"))
BAD = [
    '{"cod":401}',
    "not json",
    '{"weather":[]}',
    json.dumps({k: v for k, v in READINGS.items() if k != "visibility"}),
    None,
]


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame(
        list(enumerate([GOOD, *BAD], start=1)), "user_info_table_id bigint, payload string"
    )


def test_payload_fields_and_dropped_failures(payloads):
    got = extract_payload(payloads)
    assert got.columns == [*WEATHER_FIELDS, "user_info_table_id"]
    assert [tuple(r) for r in got.collect()] == [
        (12, "Hail", "small hail", "h1", 1.5, -0.25, 0.5, 3.0, 900, 55, 4000, 9.75, 45, 100, 1)
    ]


def test_readings_with_digits_are_kept_as_whole_numbers(spark):
    text = GOOD.replace('"pressure":900', '"pressure":899.7').replace('"deg":45', '"deg":44.6')
    row = extract_payload(spark.createDataFrame([(text,)], "payload string")).first()
    assert (row["pressure"], row["wind_deg"], row["humidity"]) == (900, 45, 55)


def test_payload_other_modes(payloads):
    kept = extract_payload(payloads, on_missing="keep")
    assert kept.count() == 6
    assert kept.where("weather_id is null").count() == 4
    assert extract_payload(payloads, required=["weather_main"]).count() == 2
    with pytest.raises(Exception, match="required field"):
        extract_payload(payloads, on_missing="fail").collect()
    with pytest.raises(ValueError):
        extract_payload(payloads, on_missing="ignore")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_date_raises_in_every_mode(spark, ansi):
    df = spark.createDataFrame([("2023-01-31",), (None,), ("2023-13-45",)], "d string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="unreadable date"):
            df.select(parse_date(F.col("d"))).collect()
        lenient = df.select(parse_date(F.col("d"), "null"))
        assert [r[0] for r in lenient.collect()] == [date(2023, 1, 31), None, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_period_start_is_a_date(spark):
    df = spark.sql("select date'2023-06-30' d")
    row = df.select(period_start(F.col("d"), "month"), period_start(F.col("d"), "quarter")).first()
    assert tuple(row) == (date(2023, 6, 1), date(2023, 4, 1))
    with pytest.raises(ValueError):
        period_start(F.col("d"), "week")


def test_first_element_of_an_empty_array(spark):
    df = spark.sql("select array(1, 2) a union all select array() union all select null")
    assert [r[0] for r in df.select(first_element(F.col("a"))).collect()] == [1, None, None]


def test_quoting(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert tuple(df.select(q("a.b"), q("c`d")).first()) == (1, 2)


def test_flatten_puts_plain_columns_first(spark):
    df = spark.createDataFrame(
        [(1, "n", "u", "e", "p", "w", ("s", "su", "c", "z", ("1.5", "-2")), ("co", "cp", "bs"))],
        USER,
    )
    moved = df.select("id", "address", "name", "company", "username", "email", "phone", "website")
    got = flatten(moved)
    assert got.columns == [
        "id", "name", "username", "email", "phone", "website", "address.street", "address.suite",
        "address.city", "address.zipcode", "address.geo.lat", "address.geo.lng", "company.name",
        "company.catchPhrase", "company.bs",
    ]
    assert got.first()["address.geo.lng"] == "-2"


def test_flatten_keeps_arrays_and_null_structs(spark):
    df = spark.sql(
        """select 1 id, array(named_struct('x', 1)) xs, named_struct('b.c', 5, 'd', 6) s
           union all select 2, null, null"""
    )
    got = flatten(df)
    assert got.columns == ["id", "xs", "s.b.c", "s.d"]
    assert rows_of(got.drop("xs")) == [(1, 5, 6), (2, None, None)]


JUNK = ["2023-01-31 junk", "2023-01-31Tjunk", "2023", "2023-01", "2023-02-01T23:59", "2023-1-5", "20230131", "", "2023-02-30"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_only_whole_dates_are_dates(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for text in JUNK:
            bad = spark.createDataFrame([(text,)], "d string")
            assert bad.select(parse_date(F.col("d"), "null")).collect()[0][0] is None
            with pytest.raises(Exception, match="unreadable date"):
                bad.select(parse_date(F.col("d"))).collect()
        good = spark.createDataFrame([(" 2023-01-31 ",), (None,)], "d string")
        assert [r[0] for r in good.select(parse_date(F.col("d")).cast("string")).collect()] == ["2023-01-31", None]
        stamps = spark.sql("select timestamp'2023-02-01 23:59:00' t, date'2023-02-01' d")
        assert stamps.select(parse_date(F.col("t")) == parse_date(F.col("d"))).collect()[0][0]
        other = spark.createDataFrame([("31.01.2023",)], "d string")
        assert str(other.select(parse_date(F.col("d"), format="dd.MM.yyyy")).collect()[0][0]) == "2023-01-31"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_readings_in_other_spellings_are_read(spark):
    text = GOOD.replace('"id":12', '"id":12.0').replace('"visibility":4000', '"visibility":"10"')
    row = extract_payload(spark.createDataFrame([(text,)], "payload string")).collect()[0]
    assert (row.weather_id, row.visibility) == (12, 10)
    for bad in (GOOD.replace('"id":12', '"id":12.5'), GOOD.replace('"visibility":4000', '"visibility":"far"')):
        assert extract_payload(spark.createDataFrame([(bad,)], "payload string")).count() == 0
