"""Golden results on the shipped sales data, if ``SALES_DATA_DIR`` names a folder that has it.

The folder must hold the sales CSV and the table dump; both are read in place.
"""

import ast
import json
import os
import re
from datetime import date
from pathlib import Path

import pytest

from salesloom.operators.flatten import flatten
from salesloom.plans.refresh import Inputs, refresh
from salesloom.sinks import ParquetSink
from salesloom.sources.files import from_records, read_users_json
from salesloom.sources.schemas import USER_WEATHER

FOLDER = os.environ.get("SALES_DATA_DIR", "")
pytestmark = pytest.mark.skipif(not FOLDER, reason="SALES_DATA_DIR is not set")

# Results that must come out.
CUSTOMERS = {
    "Chelsey Dietrich": 5801.88,
    "Clementina DuBuque": 6067.06,
    "Clementine Bauch": 5391.75,
    "Ervin Howell": 5948.32,
    "Glenna Reichert": 6142.81,
    "Kurtis Weissnat": 4934.06,
    "Leanne Graham": 4307.43,
    "Mrs. Dennis Schulist": 5411.82,
    "Nicholas Runolfsdottir V": 5891.11,
    "Patricia Lebsack": 5144.84,
}
MONTHS = {
    "2022-06": 4307.08, "2022-07": 4657.21, "2022-08": 4329.40, "2022-09": 4830.47,
    "2022-10": 4896.04, "2022-11": 4056.54, "2022-12": 4833.86, "2023-01": 4385.75,
    "2023-02": 4621.22, "2023-03": 4656.20, "2023-04": 4980.59, "2023-05": 4350.19,
    "2023-06": 136.53,
}
QUARTERS = {
    "2022-04": 4307.08, "2022-07": 13817.08, "2022-10": 13786.44, "2023-01": 13663.17,
    "2023-04": 9467.31,
}
CITIES = {
    "Aliyaview": 5891.11, "Bartholomebury": 6142.81, "Gwenborough": 4307.43,
    "Howemouth": 4934.06, "Lebsackbury": 6067.06, "McKenziehaven": 5391.75,
    "Roscoeview": 5801.88, "South Christy": 5411.82, "South Elvis": 5144.84,
    "Wisokyburgh": 5948.32,
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shipped")
    csv = next(Path(FOLDER).rglob("*.csv"))
    text = next(Path(FOLDER).rglob("*.sql")).read_text()
    inserts = [
        ast.literal_eval(f"[{v}]") for v in re.findall(r"INSERT INTO \S+ VALUES (.*);\n", text)
    ]
    weather = next(r for r in inserts if len(r[0]) == 15 and isinstance(r[0][4], float))
    people = next(r for r in inserts if len(r[0]) == 15 and isinstance(r[0][4], str))
    users = [
        {
            **dict(zip(["id", "name", "username", "email", "phone", "website"], p)),
            "address": {
                **dict(zip(["street", "suite", "city", "zipcode"], p[6:10])),
                "geo": {"lat": p[10], "lng": p[11]},
            },
            "company": dict(zip(["name", "catchPhrase", "bs"], p[12:])),
        }
        for p in people
    ]
    (root / "users.json").write_text(json.dumps(users))
    flat = flatten(read_users_json(spark, str(root / "users.json")))
    assert [tuple(r) for r in flat.collect()] == people
    payloads = []
    for w in weather:
        r = dict(zip(USER_WEATHER.fieldNames(), w))
        main = ["temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity"]
        station = {k: r["weather_" + k] for k in ["id", "main", "description", "icon"]}
        answer = {
            "weather": [station],
            "main": {k: r[k] for k in main},
            "visibility": r["visibility"],
            "wind": {"speed": r["wind_speed"], "deg": r["wind_deg"]},
            "clouds": {"all": r["cloudiness"]},
        }
        payloads.append({"user_info_table_id": w[-1], "payload": json.dumps(answer)})
    (root / "payloads.json").write_text("\n".join(json.dumps(p) for p in payloads))
    stored = refresh(
        spark,
        ParquetSink(spark, str(root / "out")),
        Inputs(str(csv), str(root / "users.json"), payloads=str(root / "payloads.json")),
    )
    expected = from_records(spark, weather, USER_WEATHER)
    assert stored["user_weather"].exceptAll(expected).count() == 0
    sales = next(r for r in inserts if len(r[0]) == 7)
    got = sorted(tuple(r) for r in stored["sales"].collect())
    assert got == sorted((*r[:5], float(r[5]), r[6]) for r in sales)
    return stored


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def by_month(df):
    return {r[0].isoformat()[:7]: r[1] for r in df.collect()}


def test_wide_table(tables):
    wide = tables["sales_enriched"]
    assert wide.count() == 1000
    assert wide.where("weather_main is null").count() == 0


def test_totals(tables):
    assert pairs(tables["results_total_sales_per_customer"]) == CUSTOMERS
    assert pairs(tables["results_total_sales_per_address_city"]) == CITIES
    assert by_month(tables["results_monthly_sales"]) == MONTHS
    assert by_month(tables["results_quarterly_sales"]) == QUARTERS
    daily = pairs(tables["results_sales_trends_over_time"])
    assert len(daily) == 343
    assert daily[date(2022, 6, 1)] == 257.92
    assert daily[date(2022, 6, 3)] == 92.90
    assert daily[date(2022, 6, 4)] == 267.14


def test_ranks(tables):
    assert pairs(tables["results_top_selling_products"]) == {
        11: 181, 36: 159, 23: 156, 26: 155, 44: 151,
    }
    top = tables["results_top_selling_customers"].orderBy("price", ascending=False)
    assert [r["name"] for r in top.collect()] == [
        "Glenna Reichert", "Clementina DuBuque", "Ervin Howell", "Nicholas Runolfsdottir V",
        "Chelsey Dietrich",
    ]


def test_means(tables):
    quantity = pairs(tables["results_average_order_quantity_per_product"])
    assert len(quantity) == 50
    assert [round(quantity[k], 6) for k in range(1, 6)] == [5.0, 5.916667, 6.307692, 6.75, 5.0]
    weather = pairs(tables["results_average_sales_per_weather"])
    assert {k: round(v, 6) for k, v in weather.items()} == {
        "Clear": 56.2625, "Clouds": 54.491121, "Rain": 54.658198,
    }
