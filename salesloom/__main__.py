"""Command line of the daily job, for ``spark-submit`` or ``python -m salesloom``.

``refresh`` lands the inputs, replaces all tables and prints what was left out; ``marts`` recomputes the results from the
stored wide table; ``restore`` replaces tables by those of a snapshot.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from salesloom.operators.lookup import LookupMemory
from salesloom.plans.refresh import Inputs, refresh, store_marts
from salesloom.session import settings_for
from salesloom.sinks import CatalogSink, JdbcSink, ParquetSink, restore_snapshot


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="salesloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    run = commands.add_parser("refresh")
    run.add_argument("--sales", required=True, help="CSV files")
    run.add_argument("--users", required=True, help="JSON files")
    run.add_argument(
        "--users-layout", choices=["lines", "array", "split_array"], default="lines",
        help="array: small files of one JSON array each",
    )
    weather = run.add_mutually_exclusive_group(required=True)
    weather.add_argument("--payloads", help="landed weather payloads")
    weather.add_argument("--fetch", help="module:function that returns a lookup of a location")
    run.add_argument("--lookup-tasks", type=int, help="tasks that look up at once")
    run.add_argument("--lookup-threads", type=int, default=5, help="calls at once in each task")
    run.add_argument("--lookup-memory", help="folder where answers of the lookup are kept for later runs")
    run.add_argument("--lookup-max-age", type=float, help="seconds after which an answer is asked again")
    run.add_argument("--payload-format", choices=["json", "parquet"], default="json")
    run.add_argument("--no-index", action="store_true", help="leave the row position out")
    run.add_argument("--on-missing", choices=["drop", "fail"], default="drop")

    commands.add_parser("marts")

    restore = commands.add_parser("restore")
    restore.add_argument("--snapshot", required=True, help="folder of a saved snapshot")
    restore.add_argument("--tables", nargs="+", default=["users", "sales", "user_weather"])

    for command in commands.choices.values():
        target = command.add_mutually_exclusive_group(required=True)
        target.add_argument("--out", help="folder of Parquet tables")
        target.add_argument("--database", help="catalog database")
        target.add_argument("--jdbc-url", help="database to write to and read from")
        command.add_argument(
            "--jdbc-properties", help="JSON file with user, password, driver and the like"
        )
        command.add_argument("--shuffle-gb", type=float, help="largest shuffle of the job, in GB")
        command.add_argument("--cores", type=int, help="executor cores, with --shuffle-gb")
    return top


def _sink(spark: SparkSession, options: argparse.Namespace):
    if options.out:
        return ParquetSink(spark, options.out)
    if options.database:
        return CatalogSink(spark, options.database)
    properties = {}
    if options.jdbc_properties:
        with open(options.jdbc_properties, encoding="utf-8") as file:
            properties = json.load(file)
    return JdbcSink(spark, options.jdbc_url, properties=properties)


def _fetch_factory(name: str | None):
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def settings(options: argparse.Namespace) -> dict[str, str]:
    if options.shuffle_gb is None:
        return {}
    return settings_for(int(options.shuffle_gb * 2**30), options.cores or 1)


def main(argv: list[str] | None = None) -> None:
    options = parser().parse_args(argv)
    spark = SparkSession.builder.appName("salesloom").config(map=settings(options)).getOrCreate()
    sink = _sink(spark, options)
    if options.command == "refresh":
        memory = None
        if options.lookup_memory:
            memory = LookupMemory(options.lookup_memory, options.lookup_max_age)
        inputs = Inputs(
            options.sales,
            options.users,
            payloads=options.payloads,
            fetch_factory=_fetch_factory(options.fetch),
            lookup_tasks=options.lookup_tasks,
            lookup_threads=options.lookup_threads,
            lookup_memory=memory,
            users_layout=options.users_layout,
            payload_format=options.payload_format,
            with_index=not options.no_index,
            on_missing=options.on_missing,
        )
        dropped: dict[str, int] = {}
        refresh(spark, sink, inputs, dropped)
        print(json.dumps(dropped))
    elif options.command == "marts":
        store_marts(sink, sink.read("sales_enriched"))
    else:
        restore_snapshot(spark, options.snapshot, options.tables, sink)


if __name__ == "__main__":
    main()
