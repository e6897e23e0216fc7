"""Sales, users and weather taken from star-schema tables, and the queries over them.

One sale is an order line with its order, a user is a customer with its nation as city, and a
user's weather is the user's last event. Every query reads the whole tables of ``sf_dir``.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from salesloom.functions.columns import parse_date, q
from salesloom.functions.payload import extract_payload
from salesloom.operators import aggregates as agg
from salesloom.operators import joins
from salesloom.operators.flatten import flatten
from salesloom.operators.lookup import LookupFailed, lookup_payloads, lookup_weather
from salesloom.operators.ordinal import with_ordinal
from salesloom.operators.float_sums import float_totals
from salesloom.plans import marts
from salesloom.plans.refresh import Inputs, refresh
from salesloom.scratch import scratch_path
from salesloom.sinks.tables import ParquetSink, restore_snapshot, save_snapshot
from salesloom.sources import files
from salesloom.sources.schemas import LONG, SALES, STRING, USER

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- inputs -------------------------------------------------------------------------------


def _stored_schema(path: str) -> StructType:
    """From the footer, each time: a table may have been rewritten with other columns."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_stored_schema(path)).parquet(path)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def sales(spark: SparkSession, sf_dir: str, known_only: bool = False) -> DataFrame:
    """All sales, or those of existing customers.

    The customer is tested on the orders, before the much longer lines are joined to them.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    headers = orders(spark, sf_dir)
    if known_only:
        ids = known_ids(spark, sf_dir)
        headers = joins.lookup_join(headers, ids, [("customer_id", "id")], "left_semi")
    joined = joins.lookup_join(lines, headers, [("order_id", "o_orderkey")])
    return joined.select(*SALES.fieldNames())


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("address.city"),
        )
    )


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``users``. Nation keys are unique, so the nation only has to exist."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
        .select(F.col("c_custkey").alias("id"))
    )


def last_events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``columns`` of the last event of each user; one row per user by construction."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max_by(F.struct(*columns), "event_id").alias("e"))
        .select("user_id", "e.*")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_events(spark, sf_dir, "event_type", "value").select(
        F.col("user_id").alias("user_info_table_id"),
        F.col("event_type").alias("weather_main"),
        F.col("value").alias("temp"),
    )


def nested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as nested records of the users' schema."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("c_custkey").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lower("c_name").alias("username"),
            F.concat(key, F.lit("@example.com")).alias("email"),
            key.alias("phone"),
            F.lit(None).cast("string").alias("website"),
            F.struct(
                F.concat(F.col("n_name"), F.lit(" street")).alias("street"),
                F.col("c_mktsegment").alias("suite"),
                F.col("n_name").alias("city"),
                F.col("c_nationkey").cast("string").alias("zipcode"),
                F.struct(
                    key.alias("lat"), F.col("n_regionkey").cast("string").alias("lng")
                ).alias("geo"),
            ).alias("address"),
            F.struct(
                F.col("c_mktsegment").alias("name"),
                F.lower("c_mktsegment").alias("catchPhrase"),
                F.col("r_name").alias("bs"),
            ).alias("company"),
        )
        .to(USER)
    )


def event_payload(visibility: Column) -> Column:
    """An event as a weather payload; fields that are NULL are left out of the text."""
    value = F.col("value")
    k = F.from_json("props", "k long")["k"]
    station = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("main"),
        F.col("props").alias("description"),
        F.lit("e").alias("icon"),
    )
    reading = F.struct(
        value.alias("temp"),
        (value + 1).alias("feels_like"),
        (value - 1).alias("temp_min"),
        (value * 2).alias("temp_max"),
        F.col("user_id").alias("pressure"),
        k.alias("humidity"),
    )
    return F.to_json(
        F.struct(
            F.array(station).alias("weather"),
            reading.alias("main"),
            visibility.alias("visibility"),
            F.struct((value / 2).alias("speed"), k.alias("deg")).alias("wind"),
            F.struct((F.col("event_id") % 101).alias("all")).alias("clouds"),
        )
    )


def user_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = last_events(spark, sf_dir, "event_id", "event_type", "value", "props")
    return events.select(
        F.col("user_id").alias("user_info_table_id"),
        event_payload(F.col("event_id")).alias("payload"),
    )


# --- joins --------------------------------------------------------------------------------


def sales_enriched(spark, sf_dir):
    # Weather has one row per user by construction, so its keys need no check.
    return joins.enrich_sales(
        sales(spark, sf_dir),
        users(spark, sf_dir),
        weather(spark, sf_dir),
        check_unique=False,
        keys_from=orders(spark, sf_dir),
    )


def sales_enriched_sql(spark, sf_dir):
    return files.read_query(
        spark,
        """select s.*, w.*, u.*
           from {s} s
           join {u} u on s.customer_id = u.id
           left join {w} w on u.id = w.user_info_table_id""",
        s=sales(spark, sf_dir),
        u=users(spark, sf_dir),
        w=weather(spark, sf_dir),
    )


def users_with_weather(spark, sf_dir):
    return joins.users_with_weather(users(spark, sf_dir), weather(spark, sf_dir))


def sales_with_users(spark, sf_dir):
    return joins.sales_with_users(
        sales(spark, sf_dir), users(spark, sf_dir), keys_from=orders(spark, sf_dir)
    )


def preview(spark, sf_dir):
    return agg.preview(
        sales_enriched(spark, sf_dir), "order_id", "product_id", "quantity", "price"
    )


# --- marts --------------------------------------------------------------------------------


def total_sales_per_customer(spark, sf_dir):
    parts = marts.user_parts(sales(spark, sf_dir), users(spark, sf_dir), "name")
    return marts.total_sales_per_customer(parts)


def top_selling_customers(spark, sf_dir):
    return marts.top_selling_customers(total_sales_per_customer(spark, sf_dir))


def total_sales_per_city(spark, sf_dir):
    parts = marts.user_parts(sales(spark, sf_dir), users(spark, sf_dir), "address.city")
    return marts.total_sales_per_city(parts)


def average_sales_per_weather(spark, sf_dir):
    parts = marts.customer_parts(
        sales(spark, sf_dir), users(spark, sf_dir), weather(spark, sf_dir)
    )
    return marts.average_sales_per_weather(parts)


def average_order_quantity_per_product(spark, sf_dir):
    return agg.average_by(sales(spark, sf_dir, known_only=True), "product_id", "quantity")


def top_selling_products(spark, sf_dir):
    return agg.top_k(sales(spark, sf_dir, known_only=True), "product_id", "quantity")


def sales_trends_daily(spark, sf_dir):
    return marts.sales_trends_over_time(sales(spark, sf_dir, known_only=True))


def sales_trends_monthly(spark, sf_dir):
    return marts.monthly_sales(sales(spark, sf_dir, known_only=True))


def sales_trends_quarterly(spark, sf_dir):
    return marts.quarterly_sales(sales(spark, sf_dir, known_only=True))


def reaggregated_customer_totals(spark, sf_dir):
    return agg.total_by(total_sales_per_customer(spark, sf_dir), "name", "price")


# --- records, payloads, lookups, row numbers ------------------------------------------------


def flatten_customer(spark, sf_dir):
    return flatten(nested_users(spark, sf_dir))


def extract_event_payload(spark, sf_dir):
    """All events as payloads; three of the five event types give payloads that fail."""
    kind = F.col("event_type")
    visibility = F.when(kind != "signup", F.col("event_id") * 10)
    payload = (
        F.when(kind == "error", F.lit('{"cod":401}'))
        .when(kind == "click", F.concat(F.lit("not json "), F.col("props")))
        .otherwise(event_payload(visibility))
    )
    rows = table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    return extract_payload(rows)


def _offline_weather():
    """Stands in for a weather service: the answer follows from the key."""

    def fetch(customer: int, nation: int) -> str | None:
        if customer % 10 == 3:
            return None
        if customer % 10 == 4:
            raise LookupFailed(customer)
        station = {
            "id": 800 + nation,
            "main": "Clear" if nation % 2 else "Clouds",
            "description": f"sky {nation}",
            "icon": "01d",
        }
        reading = {
            "temp": customer / 4,
            "feels_like": customer / 8,
            "temp_min": float(nation),
            "temp_max": nation + 0.5,
            "pressure": 1000 + nation,
            "humidity": customer % 100,
        }
        answer = {
            "weather": [station],
            "main": reading,
            "visibility": 10_000,
            "wind": {"speed": nation / 2, "deg": customer % 360},
            "clouds": {"all": nation},
        }
        if customer % 10 == 5:
            del answer["visibility"]
        return json.dumps(answer)

    return fetch


def lookup_enrich(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    keys = ["c_custkey", "c_nationkey"]
    payloads = lookup_payloads(customers, keys, _offline_weather)
    return lookup_weather(customers, payloads, keys, id_col="c_custkey")


def customer_ordinal(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_ordinal(customers, ["c_custkey"], start=1)


# --- sources and sinks ----------------------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    sales(spark, sf_dir).write.csv(path, header=True)
    read = files.read_sales_csv(spark, path)
    return read.withColumn("order_date", parse_date(q("order_date")))


def csv_line_breaks(spark, sf_dir):
    """Orders with a line break and quotes in a cell, written in key order, read back with their row position."""
    path = scratch_path(spark, "orders-breaks")
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('",\n\nend'))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", note.alias("o_note"))
    orders.orderBy("o_orderkey").write.csv(path, header=True, escape='"')
    schema = StructType([StructField("o_orderkey", LONG), StructField("o_note", STRING)])
    return files.read_csv(spark, path, schema, with_index=True, line_breaks=True)


def csv_row_index(spark, sf_dir):
    """Orders written in key order, read back with their row position."""
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    orders.orderBy("o_orderkey").write.csv(path, header=True)
    schema = StructType(
        [StructField("o_orderkey", LONG), StructField("o_orderpriority", STRING)]
    )
    return files.read_csv(spark, path, schema, with_index=True)


def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "users-json")
    nested_users(spark, sf_dir).write.json(path)
    return flatten(files.read_users_json(spark, path, layout="lines"))


def landed_payloads(spark, sf_dir):
    """Users' weather from payloads stored as JSON lines."""
    path = scratch_path(spark, "payloads")
    user_payloads(spark, sf_dir).write.json(path)
    return extract_payload(files.read_payloads(spark, path))


def table_replace(spark, sf_dir):
    sink = ParquetSink(spark, scratch_path(spark, "tables"))
    sink.replace("users", table(spark, sf_dir, "customer"))
    return sink.replace("users", users(spark, sf_dir))


def snapshot_restore(spark, sf_dir):
    folder, live = scratch_path(spark, "snapshot"), scratch_path(spark, "live")
    saved = {"sales": sales(spark, sf_dir), "users": users(spark, sf_dir)}
    save_snapshot(spark, saved, folder)
    restored = restore_snapshot(spark, folder, saved, ParquetSink(spark, live))
    return joins.sales_with_users(restored["sales"], restored["users"])


def full_refresh_results(spark, sf_dir):
    """The whole daily job over landed files; all nine result tables as one."""
    root = scratch_path(spark, "refresh")
    sales(spark, sf_dir).write.csv(f"{root}/sales", header=True)
    nested_users(spark, sf_dir).write.json(f"{root}/users")
    user_payloads(spark, sf_dir).write.json(f"{root}/payloads")
    stored = refresh(
        spark,
        ParquetSink(spark, f"{root}/tables"),
        Inputs(
            f"{root}/sales",
            f"{root}/users",
            payloads=f"{root}/payloads",
            users_layout="lines",
        ),
    )
    results = None
    for name, df in stored.items():
        if not name.startswith("results_"):
            continue
        key, value = df.columns
        rows = df.select(
            F.lit(name.removeprefix("results_")).alias("result"),
            q(key).cast("string").alias("key"),
            q(value).cast("double").alias("value"),
        )
        results = rows if results is None else results.unionAll(rows)
    return results


def charges_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with many digits: tax paid on discounts, added exactly."""
    lines = table(spark, sf_dir, "lineitem")
    charge = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")
    return agg.total_by(lines.select("l_returnflag", charge.alias("charge")), "l_returnflag", "charge")


def shares_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles with all their digits: prices as parts of 300,000, added up exactly and rounded once."""
    lines = table(spark, sf_dir, "lineitem")
    share = F.col("l_extendedprice").cast("double") / F.lit(3e5)
    return float_totals(
        lines.select("l_returnflag", share.alias("share")), "l_returnflag", "share", "total_share", "mean_share"
    )


QUERIES = {
    "extract_payload": extract_event_payload,
} | {
    f.__name__: f
    for f in (
        sales_enriched,
        sales_enriched_sql,
        users_with_weather,
        sales_with_users,
        preview,
        total_sales_per_customer,
        top_selling_customers,
        total_sales_per_city,
        average_sales_per_weather,
        average_order_quantity_per_product,
        top_selling_products,
        sales_trends_daily,
        sales_trends_monthly,
        sales_trends_quarterly,
        reaggregated_customer_totals,
        charges_by_flag,
        shares_by_flag,
        flatten_customer,
        lookup_enrich,
        customer_ordinal,
        csv_roundtrip,
        csv_row_index,
        csv_line_breaks,
        json_roundtrip,
        landed_payloads,
        table_replace,
        snapshot_restore,
        full_refresh_results,
    )
}
