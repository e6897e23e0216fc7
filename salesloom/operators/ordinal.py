"""Row numbers over a whole table without a single-task sort.

Rows are landed as Parquet first. A landed row's place is fixed by its file and its index in the
file, so the number of a row does not change when tasks are run again.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from salesloom.functions.columns import q
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land


def with_ordinal(
    df: DataFrame, order_by: list[str], start: int = 0, name: str = "ordinal"
) -> DataFrame:
    """Append the row's position in ``order_by`` order, counted from ``start``.

    Rows are range-partitioned. Equal keys are told apart by the rest of the row and exact copies
    by the partition they come from, so a key that fills a third of the table is cut into several
    ranges too. Both come out the same when a lost task is run again.
    """
    rest = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    sort = [q(c) for c in order_by] + [F.col("_content"), F.col("_origin")]
    ordered = (
        df.withColumn("_content", F.xxhash64(*[q(c) for c in rest]))
        .withColumn("_origin", F.spark_partition_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop("_content", "_origin")
    )
    landed = land(ordered, "ordinal")
    return _number(landed, {"_block": _part()}, start, name)


def with_file_position(scan: DataFrame, start: int = 0, name: str = "index") -> DataFrame:
    """Prepend the row's position in the scanned text files (files in path order).

    ``scan`` is a file scan with at most projections on it. No shuffle: a task reads a file block
    from top to end and lands it in that order, so only block lengths have to be added up.
    """
    landed = land(
        scan.select(
            "*",
            F.col("_metadata.file_path").alias("_source"),
            F.col("_metadata.file_block_start").alias("_offset"),
        ),
        "position",
    )
    numbered = _number(
        landed, {"_source": F.col("_source"), "_offset": F.col("_offset")}, start, name
    )
    return numbered.select(q(name), *[q(c) for c in scan.columns])


def with_block_position(landed: DataFrame, blocks: list[str], start: int = 0, name: str = "index") -> DataFrame:
    """Append the position of landed rows: by the columns ``blocks``, which are dropped, then as they were landed.

    ``landed`` reads a landed frame. The rows of a block lie in one task's files, one after the other.
    """
    return _number(landed, {b: q(b) for b in blocks}, start, name)


def _part() -> Column:
    """Number of the partition that wrote a landed row."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")


def _number(landed: DataFrame, blocks: dict[str, Column], start: int, name: str) -> DataFrame:
    """Number landed rows by block, then piece, then index in the piece's file.

    A task that writes several files numbers them; that number, not its text, is the piece.
    """
    columns = landed.columns
    piece = F.regexp_extract(F.col("_metadata.file_name"), r"-c(\d+)\.", 1).cast("long")
    located = landed.select(
        *[q(c) for c in columns if c not in blocks],
        *[c.alias(k) for k, c in blocks.items()],
        piece.alias("_piece"),
        F.col("_metadata.row_index").alias("_row"),
    )
    keys = [*blocks, "_piece"]
    bases = _bases(located, keys, start)
    joined = lookup_join(located, bases, [(k, f"{k}_of") for k in keys])
    out = [q(c) for c in columns if c not in blocks]
    return joined.select(*out, (F.col("_base") + F.col("_row")).alias(name))


def _bases(located: DataFrame, keys: list[str], start: int) -> DataFrame:
    """What to add to a row's index in its file, for each piece of a block.

    Pieces are range-partitioned and added up range by range; the driver gets one row per range.
    """
    spark = located.sparkSession
    lengths = located.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    ranged = land(lengths.repartitionByRange(*keys).sortWithinPartitions(*keys), "lengths")
    ranged = ranged.select("*", _part().alias("_range"))
    sums = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.sum("_n")).collect())
    before = accumulate([n for _, n in sums], initial=start)
    first = spark.createDataFrame(
        [(r, b) for (r, _), b in zip(sums, before)], "_first_range long, _before long"
    )
    order = ", ".join(f"`{k}`" for k in keys)
    within = F.expr(f"sum(_n) OVER (PARTITION BY _range ORDER BY {order}) - _n")
    numbered = ranged.withColumn("_within", within).join(
        F.broadcast(first), F.col("_range") == F.col("_first_range")
    )
    base = F.col("_before") + F.col("_within") - F.col("_first")
    return land(numbered.select(*[q(k).alias(f"{k}_of") for k in keys], base.alias("_base")), "bases")
