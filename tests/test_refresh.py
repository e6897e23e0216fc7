import json
import os
import sys

import pytest
from conftest import SALES_ROWS, rows_of
from pyspark import cloudpickle
from test_lookup import document
from test_marts import EXPECTED

from salesloom.__main__ import _fetch_factory, _sink, main, parser, settings
from salesloom.plans.refresh import Inputs, refresh, store_marts
from salesloom.sinks import CatalogSink, JdbcSink, ParquetSink, restore_snapshot, save_snapshot
from salesloom.sources.files import read_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PEOPLE = [(1, "Ann", "Rome"), (2, "Bob", "Oslo"), (3, "Ann", "Oslo"), (4, "Dee", "Lima"),
          (5, None, "Rome"), (6, "Eve", None)]
WEATHER = {1: "Clear", 2: "Rain", 4: "Clouds", 6: "Clear", 99: "Snow"}


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    lines = ["order_id,customer_id,product_id,quantity,price,order_date"]
    lines += [",".join("" if v is None else str(v) for v in row) for row in SALES_ROWS]
    (root / "sales.csv").write_text("\n".join(lines) + "\n")
    users = [
        {"id": i, "name": n, "address": {"city": c, "geo": {"lat": str(i), "lng": "0"}},
         "company": {"name": "X"}}
        for i, n, c in PEOPLE
    ]
    (root / "users.json").write_text(json.dumps(users))
    payloads = [
        {"user_info_table_id": i, "payload": document(1.0).replace("Rain", w)}
        for i, w in WEATHER.items()
    ]
    payloads.append({"user_info_table_id": 3, "payload": '{"cod":401}'})
    (root / "payloads.json").write_text("\n".join(json.dumps(p) for p in payloads))
    return {
        "sales_csv": str(root / "sales.csv"),
        "users_json": str(root / "users.json"),
        "payloads": str(root / "payloads.json"),
    }


def offline():
    def fetch(lat, lng):
        word = WEATHER.get(int(lat))
        return word and document(1.0).replace("Rain", word)

    return fetch


def check(tables):
    assert len(tables) == 13
    for name, rows in EXPECTED.items():
        assert rows_of(tables["results_" + name]) == rows, name
    wide = tables["sales_enriched"]
    assert len(wide.columns) == 37
    assert wide.columns[0] == "index"
    assert wide.schema["order_date"].dataType.simpleString() == "date"
    assert wide.count() == 12
    # Positions of the sales rows: customer 7 at position 5 is unknown.
    assert [r[0] for r in wide.select("index").orderBy("index").collect()] == [
        0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12,
    ]
    assert tables["user_weather"].columns[-1] == "user_info_table_id"


@pytest.mark.parametrize("weather", ["landed", "looked up"])
def test_refresh_to_parquet_twice(spark, inputs, tmp_path, weather):
    options = dict(inputs)
    if weather == "looked up":
        del options["payloads"]
        options["fetch_factory"] = offline
    sink = ParquetSink(spark, str(tmp_path))
    check(refresh(spark, sink, Inputs(**options)))
    check(refresh(spark, sink, Inputs(**options)))
    stored = read_table(spark, sink.path("results_total_sales_per_customer"))
    assert rows_of(stored) == EXPECTED["total_sales_per_customer"]


def test_refresh_to_catalog(spark, inputs, tmp_path):
    sink = CatalogSink(spark, root=str(tmp_path / "tables"))
    check(refresh(spark, sink, Inputs(**inputs)))
    assert rows_of(read_table(spark, "default.results_monthly_sales")) == EXPECTED["monthly_sales"]


def test_errors_end_the_run(spark, inputs, tmp_path):
    with pytest.raises(ValueError):
        Inputs(inputs["sales_csv"], inputs["users_json"])
    bad = tmp_path / "bad.csv"
    bad.write_text(
        "order_id,customer_id,product_id,quantity,price,order_date\n1,1,1,1,1.0,2023-13-45\n"
    )
    with pytest.raises(Exception, match="unreadable date"):
        sink = ParquetSink(spark, str(tmp_path / "t"))
        refresh(spark, sink, Inputs(**{**inputs, "sales_csv": str(bad)}))


@pytest.mark.parametrize("kind", ["parquet", "catalog"])
def test_a_failed_run_leaves_all_tables_as_they_were(spark, inputs, tmp_path, kind):
    if kind == "parquet":
        sink = ParquetSink(spark, str(tmp_path / "t"))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS runs")
        sink = CatalogSink(spark, "runs", root=str(tmp_path / "t"))
    check(refresh(spark, sink, Inputs(**inputs)))
    before = sorted(os.listdir(tmp_path / "t"))
    bad = tmp_path / "bad.csv"
    text = open(inputs["sales_csv"]).read()
    bad.write_text(text.replace("2023-07-01", "2023-07-01 junk"))
    with pytest.raises(Exception, match="unreadable date"):
        refresh(spark, sink, Inputs(**{**inputs, "sales_csv": str(bad)}))
    names = [f"results_{n}" for n in EXPECTED] + ["users", "sales", "user_weather", "sales_enriched"]
    check({n: sink.read(n) for n in names})
    assert sorted(os.listdir(tmp_path / "t")) == before


def test_repeated_weather_ends_the_run(spark, inputs, tmp_path):
    twice = tmp_path / "payloads.json"
    line = json.dumps({"user_info_table_id": 1, "payload": document(1.0)})
    twice.write_text(line + "\n" + line)
    sink = ParquetSink(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="repeated key"):
        refresh(spark, sink, Inputs(**{**inputs, "payloads": str(twice)}))


def test_command_line(spark, inputs, tmp_path):
    out, kept = str(tmp_path / "out"), str(tmp_path / "kept")
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(scratch))
    main(["refresh", "--sales", inputs["sales_csv"], "--users", inputs["users_json"],
          "--payloads", inputs["payloads"], "--no-index", "--out", out])
    assert set(os.listdir(scratch)) == before
    sink = ParquetSink(spark, out)
    assert len(sink.read("sales_enriched").columns) == 36
    main(["marts", "--out", out])
    for name, rows in EXPECTED.items():
        assert rows_of(sink.read("results_" + name)) == rows, name
    save_snapshot(spark, {"users": sink.read("users").where("id = 1")}, kept)
    main(["restore", "--snapshot", kept, "--tables", "users", "--out", out])
    assert sink.read("users").count() == 1


def test_marts_of_a_stored_wide_table(spark, inputs, tmp_path):
    sink = ParquetSink(spark, str(tmp_path))
    wide = refresh(spark, sink, Inputs(**inputs))["sales_enriched"]
    again = store_marts(ParquetSink(spark, str(tmp_path / "again")), wide)
    for name, rows in EXPECTED.items():
        assert rows_of(again["results_" + name]) == rows, name


def test_snapshot_restores_equal_rows(spark, users, sales, tmp_path):
    folder = str(tmp_path / "snapshot")
    save_snapshot(spark, {"users": users, "sales": sales}, folder)
    target = ParquetSink(spark, str(tmp_path / "live"))
    target.replace("users", users.where("id = 1"))
    restored = restore_snapshot(spark, folder, ["users", "sales"], target)
    assert rows_of(restored["users"]) == rows_of(users)
    assert rows_of(target.read("sales")) == rows_of(sales)


def test_replace_changes_rows_and_columns(spark, users, tmp_path):
    sink = ParquetSink(spark, str(tmp_path))
    sink.replace("t", users)
    assert sink.replace("t", users.select("id").where("id > 4")).columns == ["id"]
    assert rows_of(sink.read("t")) == [(5,), (6,)]


def test_jdbc_write_options(spark):
    sink = JdbcSink(spark, "jdbc:x", properties={"user": "me"})
    assert sink.write_options("sales") == {
        "user": "me", "url": "jdbc:x", "dbtable": "sales", "batchsize": "1000",
        "numPartitions": "8",
    }


def test_command_line_options(tmp_path):
    login = tmp_path / "login.json"
    login.write_text('{"user": "me", "driver": "d"}')
    options = parser().parse_args(
        ["refresh", "--sales", "s", "--users", "u", "--fetch", "json:loads", "--lookup-tasks", "1",
         "--jdbc-url", "jdbc:x", "--jdbc-properties", str(login), "--shuffle-gb", "400", "--cores", "100"]
    )
    assert settings(options)["spark.sql.shuffle.partitions"] == "2048"
    assert _fetch_factory(options.fetch) is json.loads
    assert (options.lookup_tasks, options.lookup_threads) == (1, 5)
    sink = _sink(None, options)
    assert sink.read_options("t") == {"user": "me", "driver": "d", "url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(SystemExit):
        parser().parse_args(["refresh", "--sales", "s", "--users", "u", "--out", "o"])


@pytest.mark.parametrize("weather", ["landed", "looked up"])
def test_left_out_rows_are_counted(spark, inputs, tmp_path, weather):
    options = dict(inputs)
    with open(inputs["sales_csv"]) as file:
        text = file.read()
    (tmp_path / "sales.csv").write_text(text + "113,,10,1,1.0,2023-07-01\n114,1,,1,1.0,2023-07-01\n")
    options["sales_csv"] = str(tmp_path / "sales.csv")
    if weather == "looked up":
        del options["payloads"]
        options["fetch_factory"] = offline
    dropped = {}
    sales = SALES_ROWS + [(113, None, 10, 1, 1.0, "2023-07-01"), (114, 1, None, 1, 1.0, "2023-07-01")]
    refresh(spark, ParquetSink(spark, str(tmp_path / "t")), Inputs(**options), dropped)
    people = {i: (name, city) for i, name, city in PEOPLE}
    known = [r for r in sales if r[1] in people]
    assert dropped == {
        "failed_lookups": 1 if weather == "landed" else sum(i not in WEATHER for i in people),
        "sales_without_customer_id": sum(r[1] is None for r in sales),
        "sales_of_unknown_customers": sum(r[1] is not None and r[1] not in people for r in sales),
        "sales_without_name": sum(people[r[1]][0] is None for r in known),
        "sales_without_city": sum(people[r[1]][1] is None for r in known),
        "sales_without_weather": sum(r[1] not in WEATHER for r in known),
        "sales_without_product_id": sum(r[2] is None for r in known),
        "sales_without_date": sum(r[5] is None for r in known),
    }
