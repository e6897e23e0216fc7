"""The result tables.

Each mart comes from one of three sets of exact partial sums, so seven tables and two period
tables need three passes over the sales, each reading only its own columns:

* customer parts (``name, address.city, weather_main`` + sum and count of price),
* product parts (``product_id`` + sum and count of quantity),
* day parts (``order_date`` + sum and count of price).

The parts can be taken from the stored wide table or straight from sales, users and weather. In
the second case customer parts are added up per customer *before* the join: the join then sees
one row per customer, however many sales the largest customer has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.operators.aggregates import (
    average_of_parts,
    largest,
    partial_sums,
    period_totals,
    total_by,
)
from salesloom.operators.joins import lookup_join, users_with_weather

CUSTOMER_KEYS = ["name", "address.city", "weather_main"]


def customer_parts(sales: DataFrame, users: DataFrame, weather: DataFrame) -> DataFrame:
    """Customer parts from the three inputs; one row per customer that has sales."""
    per_customer = partial_sums(sales, ["customer_id"], "price")
    profile = users_with_weather(
        users.select(q("id"), q("name"), q("address.city")),
        weather.select("user_info_table_id", "weather_main"),
    )
    return _attach(per_customer, profile, CUSTOMER_KEYS)


def user_parts(sales: DataFrame, users: DataFrame, key: str) -> DataFrame:
    """Customer parts for one user column; needs no weather."""
    per_customer = partial_sums(sales, ["customer_id"], "price")
    return _attach(per_customer, users.select("id", q(key)), [key])


def _attach(per_customer: DataFrame, profile: DataFrame, keys: list[str]) -> DataFrame:
    return per_customer.join(profile, F.col("customer_id") == F.col("id")).select(
        *[q(k) for k in keys], "price_sum", "price_n"
    )


def customer_parts_of_wide(wide: DataFrame) -> DataFrame:
    """Customer parts in one scan of the wide table."""
    return partial_sums(wide, CUSTOMER_KEYS, "price")


def sales_of_known(sales: DataFrame, users: DataFrame, columns: list[str], **options) -> DataFrame:
    """``columns`` of the sales whose customer exists: all a mart keyed on sales needs."""
    narrow = sales.select("customer_id", *columns)
    known = lookup_join(
        narrow, users.select("id"), [("customer_id", "id")], "inner", **options
    )
    return known.select(*columns)


def total_sales_per_customer(parts: DataFrame) -> DataFrame:
    """Customers are told apart by name, as in the wide table: equal names merge."""
    return total_by(parts, "name", "price_sum", "price")


def total_sales_per_city(parts: DataFrame) -> DataFrame:
    return total_by(parts, "address.city", "price_sum", "price")


def average_sales_per_weather(parts: DataFrame) -> DataFrame:
    """Mean price per weather; sales of customers without weather are left out."""
    return average_of_parts(parts, "weather_main", "price")


def top_selling_customers(totals: DataFrame, n: int = 5) -> DataFrame:
    """From the table of customer totals."""
    return largest(totals, "name", "price", n)


def average_order_quantity_per_product(parts: DataFrame) -> DataFrame:
    return average_of_parts(parts, "product_id", "quantity")


def top_selling_products(parts: DataFrame, n: int = 5) -> DataFrame:
    totals = total_by(parts, "product_id", "quantity_sum", "quantity")
    return largest(totals, "product_id", "quantity", n)


def sales_trends_over_time(sales: DataFrame) -> DataFrame:
    """Totals per day; ``order_date`` must be a date."""
    return total_by(sales, "order_date", "price")


def monthly_sales(daily: DataFrame) -> DataFrame:
    """From the daily table (or any rows with ``order_date, price``)."""
    return period_totals(daily, "order_date", "price", "month")


def quarterly_sales(daily: DataFrame) -> DataFrame:
    return period_totals(daily, "order_date", "price", "quarter")
