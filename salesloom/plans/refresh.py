"""The daily job: land the inputs, join them, compute and store every result table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import parse_date, q
from salesloom.functions.payload import extract_payload
from salesloom.operators.aggregates import partial_sums
from salesloom.operators.flatten import flatten
from salesloom.operators.joins import enrich_sales, require_unique
from salesloom.operators.lookup import LookupMemory, lookup_payloads, lookup_weather
from salesloom.plans import marts
from salesloom.scratch import land, temporary
from salesloom.sinks.tables import Run, Sink
from salesloom.sources.files import read_payloads, read_sales_csv, read_users_json

LOCATION = ["address.geo.lat", "address.geo.lng"]
RESULT_PREFIX = "results_"


@dataclass(frozen=True)
class Inputs:
    """What a refresh reads. Weather is either landed ``payloads`` or looked up by location."""

    sales_csv: str
    users_json: str
    payloads: str | None = None
    fetch_factory: Callable | None = None
    users_layout: str = "lines"
    payload_format: str = "json"
    with_index: bool = True
    on_missing: str = "drop"
    # Calls of the lookup that run at once: tasks times threads of a task.
    lookup_tasks: int | None = None
    lookup_threads: int = 5
    # Where answers of the lookup are kept for later runs.
    lookup_memory: LookupMemory | None = None

    def __post_init__(self):
        if (self.payloads is None) == (self.fetch_factory is None):
            raise ValueError("give either payloads or fetch_factory")


class Watch:
    """Counts of rows, taken by the jobs that pass the rows on anyway."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def rows(self, name: str, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, counted as ``name``; ``counts`` are conditions whose rows are counted, too."""
        self._seen[name] = Observation()
        more = [F.count_if(condition).alias(c) for c, condition in counts.items()]
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"), *more)

    def dropped(self) -> dict[str, int]:
        """After the run: what has no row in a table or result, by reason."""
        seen = {name: o.get for name, o in self._seen.items()}
        sales, wide = seen["sales"], seen["sales_enriched"]
        return {
            "failed_lookups": seen["lookups"]["rows"] - seen["user_weather"]["rows"],
            "sales_without_customer_id": sales["no_customer"],
            "sales_of_unknown_customers": sales["rows"] - sales["no_customer"] - wide["rows"],
            **{f"sales_{reason}": wide[reason] for reason in LEFT_OUT},
        }


# Why a sale of the wide table has no part in some result, and the column whose NULL says so.
LEFT_OUT = {
    "without_name": "name",
    "without_city": "address.city",
    "without_weather": "weather_main",
    "without_product_id": "product_id",
    "without_date": "order_date",
}


def refresh(
    spark: SparkSession, sink: Sink, inputs: Inputs, dropped: dict[str, int] | None = None
) -> dict[str, DataFrame]:
    """Replace all tables of ``sink`` and return them, as stored, by name.

    Every stage is written before the next one reads it, and stages that do not need each other
    are submitted side by side. Any error ends the run and leaves all stored tables as they were.

    ``dropped``, where given, gets the counts of :meth:`Watch.dropped`. They are observed while the tables are
    written, without a job of their own; a stage that is run again after a lost executor may count its rows twice.
    """
    watch = Watch()
    with Run(sink) as run:
        _refresh(spark, run, inputs, watch)
    if dropped is not None:
        dropped.update(watch.dropped())
    return run.stored()


def _refresh(spark: SparkSession, run: Run, inputs: Inputs, watch: Watch) -> None:
    tables, store = run.frames, run.replace

    def users_and_weather():
        nested = read_users_json(spark, inputs.users_json, inputs.users_layout)
        users = store("users", flatten(nested))
        store("user_weather", watch.rows("user_weather", _weather(spark, users, inputs, watch)))

    def sales():
        rows = read_sales_csv(spark, inputs.sales_csv, inputs.with_index)
        store("sales", watch.rows("sales", rows, no_customer=q("customer_id").isNull()))

    def marts_of_customers():
        # Summed per customer before the join, so not from the wide table; the same rows.
        parts = marts.customer_parts(tables["sales"], tables["users"], tables["user_weather"])
        _store_customer_marts(store, parts)

    def wide_and_its_marts():
        joined = enrich_sales(
            tables["sales"], tables["users"], tables["user_weather"], check_unique=False
        )
        dated = joined.withColumn("order_date", parse_date(q("order_date")))
        missing = {reason: q(c).isNull() for reason, c in LEFT_OUT.items()}
        wide = store("sales_enriched", watch.rows("sales_enriched", dated, **missing))
        _together(
            lambda: _store_product_marts(store, wide), lambda: _store_period_marts(store, wide)
        )

    with temporary(spark):
        _together(users_and_weather, sales)
        require_unique(tables["user_weather"], "user_info_table_id")
        _together(wide_and_its_marts, marts_of_customers)


def store_marts(sink: Sink, wide: DataFrame) -> dict[str, DataFrame]:
    """Replace the nine result tables from a stored wide table, in three scans of it."""
    with Run(sink) as run, temporary(wide.sparkSession):
        _together(
            lambda: _store_customer_marts(run.replace, marts.customer_parts_of_wide(wide)),
            lambda: _store_product_marts(run.replace, wide),
            lambda: _store_period_marts(run.replace, wide),
        )
    return run.stored()


def _weather(spark: SparkSession, users: DataFrame, inputs: Inputs, watch: Watch) -> DataFrame:
    if inputs.payloads is not None:
        rows = watch.rows("lookups", read_payloads(spark, inputs.payloads, inputs.payload_format))
        return extract_payload(rows, on_missing=inputs.on_missing)
    rows = lookup_payloads(
        users, LOCATION, inputs.fetch_factory, inputs.lookup_tasks, inputs.lookup_threads,
        inputs.on_missing, inputs.lookup_memory,
    )
    users = watch.rows("lookups", users.select("id", *[q(c) for c in LOCATION]))
    return lookup_weather(users, rows, LOCATION, on_missing=inputs.on_missing)


def _store_customer_marts(store, parts: DataFrame) -> None:
    parts = land(parts, "customer-parts")
    totals = marts.total_sales_per_customer(parts)
    totals = store(RESULT_PREFIX + "total_sales_per_customer", totals)
    store(RESULT_PREFIX + "top_selling_customers", marts.top_selling_customers(totals))
    store(RESULT_PREFIX + "total_sales_per_address_city", marts.total_sales_per_city(parts))
    store(RESULT_PREFIX + "average_sales_per_weather", marts.average_sales_per_weather(parts))


def _store_product_marts(store, wide: DataFrame) -> None:
    parts = land(partial_sums(wide, ["product_id"], "quantity"), "product-parts")
    store(
        RESULT_PREFIX + "average_order_quantity_per_product",
        marts.average_order_quantity_per_product(parts),
    )
    store(RESULT_PREFIX + "top_selling_products", marts.top_selling_products(parts))


def _store_period_marts(store, wide: DataFrame) -> None:
    daily = store(RESULT_PREFIX + "sales_trends_over_time", marts.sales_trends_over_time(wide))
    store(RESULT_PREFIX + "monthly_sales", marts.monthly_sales(daily))
    store(RESULT_PREFIX + "quarterly_sales", marts.quarterly_sales(daily))


def _together(*steps: Callable[[], None]) -> None:
    """Run steps from threads of their own; raise the first error once all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(copy_context().run, step) for step in steps]
    for step in running:
        step.result()
