"""Declared schemas. Nothing is inferred: column types never depend on the day's data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


LONG, DOUBLE, STRING = LongType(), DoubleType(), StringType()

SALES = _struct(
    order_id=LONG,
    customer_id=LONG,
    product_id=LONG,
    quantity=LONG,
    price=DOUBLE,
    order_date=STRING,
)

USER = _struct(
    id=LONG,
    name=STRING,
    username=STRING,
    email=STRING,
    phone=STRING,
    website=STRING,
    address=_struct(
        street=STRING,
        suite=STRING,
        city=STRING,
        zipcode=STRING,
        geo=_struct(lat=STRING, lng=STRING),
    ),
    company=_struct(name=STRING, catchPhrase=STRING, bs=STRING),
)

# Numbers are read as text and cast: services send 1014.32 where a whole number is stored, 803.0 as an
# id, or "10" in quotes.
WEATHER_PAYLOAD = _struct(
    weather=ArrayType(_struct(id=STRING, main=STRING, description=STRING, icon=STRING)),
    main=_struct(
        temp=STRING,
        feels_like=STRING,
        temp_min=STRING,
        temp_max=STRING,
        pressure=STRING,
        humidity=STRING,
    ),
    visibility=STRING,
    wind=_struct(speed=STRING, deg=STRING),
    clouds=_struct(all=STRING),
)

USER_WEATHER = _struct(
    weather_id=LONG,
    weather_main=STRING,
    weather_description=STRING,
    weather_icon=STRING,
    temp=DOUBLE,
    feels_like=DOUBLE,
    temp_min=DOUBLE,
    temp_max=DOUBLE,
    pressure=LONG,
    humidity=LONG,
    visibility=LONG,
    wind_speed=DOUBLE,
    wind_deg=LONG,
    cloudiness=LONG,
    user_info_table_id=LONG,
)
WEATHER_FIELDS = tuple(USER_WEATHER.fieldNames()[:-1])

USER_PAYLOAD = _struct(user_info_table_id=LONG, payload=STRING)

MART_SCHEMAS = {
    "total_sales_per_customer": _struct(name=STRING, price=DOUBLE),
    "average_order_quantity_per_product": _struct(product_id=LONG, quantity=DOUBLE),
    "top_selling_products": _struct(product_id=LONG, quantity=LONG),
    "top_selling_customers": _struct(name=STRING, price=DOUBLE),
    "sales_trends_over_time": _struct(order_date=DateType(), price=DOUBLE),
    "average_sales_per_weather": _struct(weather_main=STRING, price=DOUBLE),
    "total_sales_per_address_city": _struct(**{"address.city": STRING, "price": DOUBLE}),
    "monthly_sales": _struct(order_date=DateType(), price=DOUBLE),
    "quarterly_sales": _struct(order_date=DateType(), price=DOUBLE),
}
