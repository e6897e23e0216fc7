"""Landed inputs: sales CSV, customer JSON, weather payloads, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from salesloom.functions.columns import q
from salesloom.operators.ordinal import with_file_position
from salesloom.sources.arrays import read_array
from salesloom.sources.records import read_records
from salesloom.sources.schemas import SALES, USER, USER_PAYLOAD

# Cell texts that a CSV reader with default settings takes as missing.
MISSING_CELLS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, with_index: bool = False,
    line_breaks: bool = False,
) -> DataFrame:
    """Header CSV with a declared schema.

    Cells are read as text, missing ones become NULL, the rest is cast; a cell that does not
    fit its type, a row of the wrong length or a different header stops the job.
    ``with_index`` adds the 0-based row position as first column ``index``.

    ``line_breaks`` reads quoted cells with line breaks, and still splits large files, for a copy of the
    lines and one of the records in the scratch folder; without it such a cell stops the job.
    """
    if line_breaks:
        return read_records(spark, path, schema, _cell, with_index)
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = spark.read.csv(
        path, schema=text, header=True, mode="FAILFAST", enforceSchema=False, quote='"', escape='"'
    )
    typed = raw.select(*[_cell(f) for f in schema.fields])
    return with_file_position(typed) if with_index else typed


def _cell(field: StructField):
    """A text cell as its declared type. A readable cell is cast once and not looked up."""
    cell = q(field.name)
    if isinstance(field.dataType, StringType):
        return F.when(~cell.isin(MISSING_CELLS), cell).alias(field.name)
    # Spark also reads the suffixes of number literals, as in 2.5d and 3f; they are no part of a number here.
    number_text = F.when(~cell.rlike(r"[0-9.]\s*[dDfF]\s*$"), cell)
    typed = (number_text if isinstance(field.dataType, DoubleType) else cell).try_cast(field.dataType)
    if isinstance(field.dataType, DoubleType):
        typed = F.nanvl(typed, F.lit(None).cast("double"))
    if isinstance(field.dataType, LongType):
        # A whole number column that once had gaps is written as 3.0.
        number = number_text.try_cast("double")
        typed = F.coalesce(typed, F.when(number == F.rint(number), number.try_cast("long")))
    message = F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), cell)
    unreadable = F.raise_error(message).cast(field.dataType)
    return F.coalesce(typed, F.when(~cell.isin(MISSING_CELLS), unreadable)).alias(field.name)


def read_sales_csv(
    spark: SparkSession, path: str | list[str], with_index: bool = False, line_breaks: bool = False
) -> DataFrame:
    """Sales as declared in ``SALES``; ``order_date`` stays text until after the join."""
    return read_csv(spark, path, SALES, with_index, line_breaks)


def read_users_json(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "lines",
    schema: StructType = USER,
) -> DataFrame:
    """Nested customer records.

    ``layout="lines"`` reads one object per line and splits large files. ``layout="array"`` is for
    small files that each hold one JSON array: one task reads a whole file. ``layout="split_array"``
    reads such files of any size in many tasks, and lands them once for that.
    """
    if layout not in ("array", "lines", "split_array"):
        raise ValueError(f"layout must be 'array', 'lines' or 'split_array', not {layout!r}")
    if layout == "split_array":
        return read_array(spark, path, schema)
    return spark.read.json(
        path, schema=schema, multiLine=layout == "array", mode="FAILFAST"
    )


def read_payloads(
    spark: SparkSession, path: str | list[str], format: str = "json"
) -> DataFrame:
    """Landed lookups: ``user_info_table_id`` and the payload text, as JSON lines or Parquet.

    A line that is not such an object, or has no id, stops the job; only the payload may be bad.
    """
    reader = spark.read.schema(USER_PAYLOAD).format(format)
    rows = (reader.option("mode", "FAILFAST") if format == "json" else reader).load(path)
    key = q("user_info_table_id")
    missing = F.raise_error(F.lit("landed payload without user_info_table_id")).cast("long")
    return rows.withColumn("user_info_table_id", F.coalesce(key, missing))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A stored table: a path (it holds a slash) of Parquet files, or a catalog name."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL; ``{name}`` in the text stands for the frame passed under that name."""
    return spark.sql(text, **tables)


def from_records(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Small in-memory records as a table; without rows it still has its columns."""
    names = schema.fieldNames()
    values = [tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r) for r in rows]
    return spark.createDataFrame(values, schema)
