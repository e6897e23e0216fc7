"""Reads from a database. Credentials and URL come from the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How one read is cut into parallel queries: ranges of a number, date or timestamp."""

    column: str
    lower: str | int
    upper: str | int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def read_options(
    url: str, source: str, split: Split | None, fetch_size: int, properties: dict[str, str]
) -> dict[str, str]:
    """Spark options for a table name or a query text (anything with white space)."""
    is_query = len(source.split()) > 1
    options = {**properties, "url": url, "fetchsize": str(fetch_size)}
    if split is None:
        options["query" if is_query else "dbtable"] = source
        return options
    # `query` cannot be combined with a partition column; a derived table can.
    options["dbtable"] = f"({source}) source_query" if is_query else source
    return {**options, **split.options()}


def read_jdbc(
    spark: SparkSession,
    url: str,
    source: str,
    split: Split | None,
    fetch_size: int = 10_000,
    **properties: str,
) -> DataFrame:
    """A whole table or a query's result.

    ``split`` must be given: without one (None) a single task reads everything, which is right
    only for result tables of known small size.
    """
    options = read_options(url, source, split, fetch_size, properties)
    return spark.read.format("jdbc").options(**options).load()
