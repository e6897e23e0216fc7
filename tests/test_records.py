"""CSV with line breaks in quoted cells, against pandas and over many splits."""

import csv
import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from salesloom.operators import ordinal
from salesloom.sources import records
from salesloom.sources.files import read_csv
from salesloom.sources.records import csv_records

SCHEMA = StructType([StructField("k", LongType()), StructField("text", StringType()), StructField("v", DoubleType())])


def random_text(rng):
    return "".join(rng.choice(["a", "b", " ", ",", "\n", "\n\n", '"', '""', "x\r\ny", "ä", ";"]) for _ in range(rng.randrange(12)))


def write(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["k", "text", "v"])
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_equals_pandas(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    rows = [(i, random_text(rng), rng.choice([1.5, -2.0, ""])) for i in range(800)]
    rows[17] = (17, "\n" * 900 + "long, over several splits" + "\n" * 900, 0.5)
    write(tmp_path / "t.csv", rows, end)
    want = pd.read_csv(tmp_path / "t.csv", lineterminator=None if end == "\r\n" else "\n")
    frame = read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, with_index=True, line_breaks=True)
    assert spark.read.text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 2
    got = sorted(map(tuple, frame.collect()))
    assert len(got) == len(want) == 800
    for i, (index, k, text, v) in enumerate(got):
        own = want.iloc[i]
        assert (index, k) == (i, own.k)
        assert text == (None if pd.isna(own.text) else own.text)
        assert v == (None if pd.isna(own.v) else own.v)


def test_several_files_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,text,v\n\n1,"x\n\ny",2\n\n')
    (tmp_path / "b.csv").write_text('k,text,v\n2,z,3')
    (tmp_path / "c.csv").write_text("k,text,v\n")
    frame = read_csv(spark, str(tmp_path), SCHEMA, with_index=True, line_breaks=True)
    assert sorted(map(tuple, frame.collect())) == [(0, 1, "x\n\ny", 2.0), (1, 2, "z", 3.0)]
    assert csv_records(spark, str(tmp_path)).where("_head").count() == 3


@pytest.mark.parametrize("text, message", [
    ('k,text,v\n1,"x\n2,y,3\n', "not closed"),
    ("k,other,v\n1,x,2\n", "unexpected header"),
    ("k,text,v,w\n1,x,2,3\n", "unexpected header"),
    ("k,text\n1,x\n", "unexpected header"),
    ("k,text,v\n1,x\n", "MALFORMED|Malformed"),
    ("k,text,v\n1,x,2,3\n", "MALFORMED|Malformed"),
    ("k,text,v\n1,x,2.5d\n", "v is not double"),
    ("k,text,v\n3f,x,2\n", "k is not bigint"),
])
def test_bad_files_stop(spark, tmp_path, text, message):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, line_breaks=True).collect()


@pytest.mark.parametrize("cell", ["2.5d", "3f", "1D", "2.F ", "1e3d"])
def test_suffixes_are_no_numbers(spark, tmp_path, cell):
    (tmp_path / "t.csv").write_text(f"k,text,v\n1,x,{cell}\n")
    with pytest.raises(Exception, match="v is not double"):
        read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).collect()


def test_numbers_still_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,text,v\n1,2.5d,inf\n3.0,f,-Infinity\n4,,1e-3\n5,d,.5\n")
    got = read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).orderBy("k").collect()
    assert [tuple(r) for r in got] == [
        (1, "2.5d", float("inf")), (3, "f", float("-inf")), (4, None, 1e-3), (5, "d", 0.5)]


def test_only_records_of_several_lines_move(spark, tmp_path):
    write(tmp_path / "t.csv", [(i, "plain", 1.0) for i in range(500)] + [(500, "two\nlines", 2.0)])
    records = csv_records(spark, str(tmp_path / "t.csv"))
    assert records.count() == 502
    assert records.where(F.col("_record").contains("\n")).count() == 1


def test_lines_in_many_pieces_equal_pandas(spark, tmp_path, small_splits, monkeypatch):
    """Tasks land several files and read them in small batches; nothing is sorted, few parts of records move."""
    landed = {}

    def spy(land):
        def run(df, label, keep=False):
            landed[label] = land(df, label, keep)
            return landed[label]
        return run

    monkeypatch.setattr(records, "land", spy(records.land))
    monkeypatch.setattr(ordinal, "land", spy(ordinal.land))
    rng = random.Random(4)
    cells = [(i, random_text(rng), 0.5) for i in range(1500)]
    cells[40] = (40, "\n" * 700 + "end", 0.5)
    write(tmp_path / "t.csv", cells)
    want = pd.read_csv(tmp_path / "t.csv", lineterminator="\n")
    conf = {"spark.sql.files.maxRecordsPerFile": "100", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        frame = read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, with_index=True, line_breaks=True)
        got = sorted(map(tuple, frame.select("index", "k", "text").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == [(i, i, None if pd.isna(t) else t) for i, t in enumerate(want.text)]
    assert "ordinal" not in landed
    lines = landed["lines"].count()
    assert 0 < landed["groups"].count() < lines / 10 and lines > 2000
