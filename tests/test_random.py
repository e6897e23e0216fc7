"""Random sales with gaps, compared with an in-memory join and grouping."""

import numpy as np
import pandas as pd
import pytest
from conftest import USERS, WEATHER
from pyspark.sql.types import DateType, StructField, StructType

from salesloom.operators import aggregates as agg
from salesloom.operators.joins import enrich_sales
from salesloom.plans import marts
from salesloom.sources.files import from_records
from salesloom.sources.schemas import SALES

DATED = StructType([*SALES.fields[:-1], StructField("order_date", DateType())])


def draw(rng, values, n, gaps=0.05):
    picked = rng.choice(np.array(values, dtype=object), n)
    return [None if g else v for v, g in zip(picked, rng.random(n) < gaps)]


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(request):
    rng = np.random.default_rng(request.param)
    n, people = 400, 30
    days = [d.date() for d in pd.date_range("2022-11-01", periods=200)]
    customers = [int(c) for c in rng.integers(0, 40, n)]
    customers = [3 if i % 3 == 0 else c for i, c in enumerate(customers)]
    prices = [None if p is None else float(p) / 100 for p in draw(rng, range(5000), n)]
    prices[7] = float("nan")
    sales = list(
        zip(
            range(n), customers, draw(rng, range(12), n), draw(rng, range(1, 4), n), prices,
            draw(rng, days, n),
        )
    )
    users = [
        (i, name, city)
        for i, (name, city) in enumerate(
            zip(draw(rng, ["Ann", "Bob", "Cyd", "Dee", "Eve", "Flo", "Gus"], people),
                draw(rng, ["Rome", "Oslo", "Lima"], people))
        )
    ]
    weather = [(i, w) for i, w in enumerate(draw(rng, ["Clear", "Rain", "Snow"], 45)) if i % 4]
    return sales, users, weather


def frame(rows, schema):
    return pd.DataFrame(rows, columns=schema.fieldNames())


def expected(data):
    sales, users, weather = data
    people = frame(users, USERS).merge(
        frame(weather, WEATHER), how="left", left_on="id", right_on="user_info_table_id"
    )
    wide = frame(sales, DATED).merge(people, left_on="customer_id", right_on="id")
    for name in ["price", "quantity"]:
        wide[name] = wide[name].astype("float64")
    return wide


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def same(got, series):
    want = {k: (None if pd.isna(v) else v) for k, v in series.items()}
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == (value if value is None else pytest.approx(value, rel=1e-12, abs=1e-9))


@pytest.mark.parametrize("way", ["wide", "inputs"])
def test_marts_agree(spark, data, way):
    sales, users, weather = (
        from_records(spark, rows, schema) for rows, schema in zip(data, [DATED, USERS, WEATHER])
    )
    flat = expected(data)
    if way == "wide":
        known = enrich_sales(sales, users, weather)
        parts = marts.customer_parts_of_wide(known)
        assert known.count() == len(flat)
    else:
        known = marts.sales_of_known(
            sales, users, ["product_id", "quantity", "order_date", "price"]
        )
        parts = marts.customer_parts(sales, users, weather)
    products = agg.partial_sums(known, ["product_id"], "quantity")

    def grouped(key, value):
        return flat.groupby(key)[value]

    totals = marts.total_sales_per_customer(parts)
    same(as_dict(totals), grouped("name", "price").sum())
    same(as_dict(marts.total_sales_per_city(parts)), grouped("address.city", "price").sum())
    same(as_dict(marts.average_sales_per_weather(parts)), grouped("weather_main", "price").mean())
    same(
        as_dict(marts.average_order_quantity_per_product(products)),
        grouped("product_id", "quantity").mean(),
    )
    same(as_dict(marts.sales_trends_over_time(known)), grouped("order_date", "price").sum())
    top = grouped("product_id", "quantity").sum().nlargest(5)
    rows = [tuple(r) for r in marts.top_selling_products(products).collect()]
    assert rows == [(k, int(v)) for k, v in top.items()]
    best = grouped("name", "price").sum().nlargest(5)
    assert [r[0] for r in marts.top_selling_customers(totals).collect()] == list(best.index)

    month = pd.PeriodIndex(pd.to_datetime(flat["order_date"]), freq="M")
    quarter = pd.PeriodIndex(pd.to_datetime(flat["order_date"]), freq="Q")
    for index, mart in [(month, marts.monthly_sales), (quarter, marts.quarterly_sales)]:
        by_period = flat["price"].groupby(index).sum()
        by_period.index = by_period.index.to_timestamp().date
        same(as_dict(mart(known)), by_period)
