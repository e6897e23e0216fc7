"""Nested records to dotted columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from salesloom.functions.columns import q


def _leaves(column: Column, name: str, schema: StructType, sep: str) -> list[Column]:
    found = []
    for field in schema.fields:
        child, label = column.getField(field.name), f"{name}{sep}{field.name}"
        if isinstance(field.dataType, StructType):
            found += _leaves(child, label, field.dataType, sep)
        else:
            found.append(child.alias(label))
    return found


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Turn every struct into columns named by their path; arrays stay one column.

    Plain columns come first, the leaves of each struct after them in order.
    """
    plain, nested = [], []
    for field in df.schema.fields:
        if isinstance(field.dataType, StructType):
            nested += _leaves(q(field.name), field.name, field.dataType, sep)
        else:
            plain.append(q(field.name))
    return df.select(*plain, *nested)
