"""CSV whose quoted cells may hold line breaks, in files of any size.

Spark splits a large file at line ends, so a task may begin inside a quoted cell and cannot know it. Whether a line
begins inside one follows from how many quotes lie before it in the file: an odd number means it does. A task counts
them from the top of its block, and the odd ones among the blocks before add up to one bit a block. With that, each
task puts the records of its lines together as it reads them. Only records that run from one task's lines into
another's are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.functions.columns import q
from salesloom.operators.joins import lookup_join
from salesloom.operators.ordinal import with_block_position
from salesloom.scratch import land

_OPTIONS = {"quote": '"', "escape": '"'}
# Where a line lies: its file, the block of it that a task read, the piece of what that task landed, and the row there.
_PLACE = ["_path", "_offset", "_part", "_line"]
_LINES = "value string, _path string, _offset long, _odd boolean, _inside boolean, _first boolean"
# A record's or a part's text, its first line's place, the row that its run of lines begins with, and what it is.
_PARTS = "value string, _path string, _offset long, _part long, _line long, _run long, _kind int, _head boolean"
WHOLE, OPENED, CONTINUED = 0, 1, 2


def _changes(batch: pa.RecordBatch, names: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """Whether a row has another value in one of the columns than the row before it."""
    changed = np.zeros(batch.num_rows, bool)
    changed[0] = last is None
    for name in names:
        column = batch[name]
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        changed[0] |= last is not None and last[name][0] != column[0]
    return changed


def _in_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a line has an odd number of quotes, whether such a number lies before it in its block, and whether it heads it."""
    last, inside = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        odd = pc.count_substring(batch["value"], '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
        first = _changes(batch, ["_path", "_offset"], last)
        before = np.cumsum(odd) - odd
        top = np.maximum.accumulate(np.where(first, np.arange(len(odd)), -1))
        within = (before - np.where(top >= 0, before[top], -inside)) & 1
        last, inside = batch.slice(batch.num_rows - 1), int(within[-1] ^ odd[-1])
        added = [pa.array(odd == 1), pa.array(within == 1), pa.array(first)]
        yield pa.record_batch([batch["value"], batch["_path"], batch["_offset"], *added],
                              names=["value", "_path", "_offset", "_odd", "_inside", "_first"])


def _together(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Records of the lines held, from one line where ``_begins`` to the next."""
    batch, *more = pa.Table.from_batches(held).combine_chunks().to_batches()
    if more:
        raise ValueError("a record of more than 2 GB")
    starts = np.flatnonzero(batch["_begins"].to_numpy(zero_copy_only=False))
    ends = np.append(starts[1:], batch.num_rows)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, batch.num_rows).astype(np.int32)), batch["value"])
    own, final = batch.take(pa.array(starts)), batch.take(pa.array(ends - 1))
    inside = own["_inside"].to_numpy(zero_copy_only=False)
    unclosed = pc.xor(final["_inside"], final["_odd"]).to_numpy(zero_copy_only=False)
    kind = np.where(inside, CONTINUED, np.where(unclosed, OPENED, WHOLE)).astype(np.int32)
    arrays = [pc.binary_join(lists, "\n"), *[own[c] for c in _PLACE], own["_run"], pa.array(kind), own["_head"]]
    return pa.record_batch(arrays, names=["value", *_PLACE, "_run", "_kind", "_head"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that come in order, and at both ends of a run of lines the parts of those that go on elsewhere."""
    last, run, held = None, 0, []
    for batch in batches:
        if not batch.num_rows:
            continue
        row = batch["_line"].to_numpy(zero_copy_only=False)
        fresh = _changes(batch, ["_path", "_offset", "_part"], last)
        fresh[1:] |= row[1:] != row[:-1] + 1
        fresh[0] |= last is not None and last["_line"][0].as_py() + 1 != row[0]
        top = np.maximum.accumulate(np.where(fresh, np.arange(len(row)), -1))
        runs = np.where(top >= 0, row[top], run)
        last, run = batch.slice(batch.num_rows - 1), int(runs[-1])
        begins = fresh | ~batch["_inside"].to_numpy(zero_copy_only=False)
        batch = batch.append_column("_run", pa.array(runs)).append_column("_begins", pa.array(begins))
        at = np.flatnonzero(begins)
        if len(at):
            # Held is what may go on in this batch; what begins last may go on in the next one.
            held.append(batch.slice(0, at[-1]))
            if sum(b.num_rows for b in held):
                yield _together(held)
            held = [batch.slice(at[-1])]
        else:
            held.append(batch)
    if held:
        yield _together(held)


def _landed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in place, and whether each begins ``_inside`` a quoted cell; a cell that stays open raises ``ValueError``."""
    scan = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_offset")
    )
    lines = land(scan.mapInArrow(_in_quotes, _LINES), "lines")
    blocks = land(lines.groupBy("_path", "_offset").agg(F.sum(F.col("_odd").cast("int")).alias("_odds")), "blocks")
    unclosed = blocks.groupBy("_path").agg(F.sum("_odds").alias("_odds")).where("_odds % 2 = 1").limit(1).collect()
    if unclosed:
        raise ValueError(f"a quoted cell is not closed in {unclosed[0]['_path']}")
    before = F.expr("sum(_odds) OVER (PARTITION BY _path ORDER BY _offset) - _odds")
    cut = land(
        blocks.select(F.col("_path").alias("_in"), F.col("_offset").alias("_from"), (before % 2 == 1).alias("_cut"))
        .where("_cut"),
        "cut",
    )
    located = lines.select(
        *lines.columns,
        F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), r"-c(\d+)\.", 1).try_cast("long"), F.lit(0)).alias("_part"),
        F.col("_metadata.row_index").alias("_line"),
    )
    # One row for each block that begins inside a cell. A broadcast keeps the lines in order.
    placed = located.join(
        F.broadcast(cut), (F.col("_path") == F.col("_in")) & (F.col("_offset") == F.col("_from")), "left"
    )
    return placed.select(
        "value", *_PLACE, "_odd", (F.col("_inside") != F.coalesce("_cut", F.lit(False))).alias("_inside"),
        F.expr("_first AND _offset = 0").alias("_head"),
    )


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_at, _head, _record``: the text of each record, and whether it heads a file.

    ``_at`` is the 0-based position among the records that head none (files in path order), NULL for those that do.
    Lines end at a line feed; a carriage return before the one that ends a record is no part of it, and inside a
    quoted cell it stays. Empty lines between records are left out. A file that ends inside a quoted cell raises ``ValueError``.

    Lines are landed once, and records in their order; nothing is sorted, and only records that lie in several
    tasks' lines are shuffled. A record has to fit a task.
    """
    text = F.regexp_replace("value", "\r$", "")
    parts = _landed_lines(spark, path).mapInArrow(_parts, _PARTS)
    parts = land(
        parts.withColumn("value", F.when(F.col("_kind") == WHOLE, text).otherwise(F.col("value")))
        .where(f"_head OR _kind <> {WHOLE} OR value <> ''"),
        "parts",
    )
    split = parts.where(f"_kind <> {WHOLE}")
    # Places only, two for each task and block of lines.
    opened = F.expr(f"sum(int(_kind = {OPENED})) OVER (PARTITION BY _path ORDER BY _offset, _part, _line)")
    names = {c: f"{c}_of" for c in _PLACE}
    groups = land(split.select(*_PLACE, opened.alias("_record")).withColumnsRenamed(names), "groups")
    pieces = F.array_sort(F.collect_list(F.struct(*_PLACE, "value")))
    joined = lookup_join(split.select(*_PLACE, "value"), groups, list(names.items())).groupBy("_path", "_record").agg(
        pieces.alias("_pieces")
    )
    whole = F.array_join(F.transform("_pieces", lambda p: p["value"]), "\n").alias("value")
    several = land(
        joined.select(*[F.col("_pieces")[0][c].alias(f"{c}_of") for c in _PLACE], whole).select(
            *names.values(), text.alias("_whole")
        ),
        "several",
    )
    starts = parts.where(f"_kind <> {CONTINUED}")
    heads = starts.where("_head").select(F.lit(None).cast("long").alias("_at"), *_PLACE, "_head", "_kind", "value")
    # A block of records is a run of lines. Numbering drops its names, so they are copies.
    body = starts.where("NOT _head").select(
        *_PLACE, "_head", "_kind", "value",
        F.col("_path").alias("_b1"), F.col("_offset").alias("_b2"), F.col("_part").alias("_b3"), F.col("_run").alias("_b4"),
    )
    body = with_block_position(body, ["_b1", "_b2", "_b3", "_b4"], name="_at").select(*heads.columns)
    records = lookup_join(body.unionByName(heads), several, list(names.items()), "left")
    return records.select("_at", "_head", F.coalesce("_whole", "value").alias("_record"))


def read_records(
    spark: SparkSession, path: str | list[str], schema: StructType, cell: Column, with_index: bool
) -> DataFrame:
    """Typed rows of :func:`csv_records`; ``cell`` makes a column of the schema from its text.

    Every file has a header. Another header or a record of another length stops the job.
    """
    names = schema.fieldNames()
    records = csv_records(spark, path)
    plain = [f"c{i}" for i in range(len(names))]
    header = F.from_csv("_record", ", ".join(f"{c} string" for c in [*plain, "more"]), _OPTIONS)
    right = F.lit(True)
    for c, name in zip(plain, names):
        right = right & F.col("_cells")[c].eqNullSafe(F.lit(name))
    right = right & F.col("_cells")["more"].isNull()
    wrong = records.where("_head").select("_record", header.alias("_cells")).where(~right).limit(1).collect()
    if wrong:
        raise ValueError(f"unexpected header: {wrong[0]['_record']}")
    declared = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    cells = F.from_csv("_record", declared, {**_OPTIONS, "mode": "FAILFAST"})
    body = records.where("NOT _head").select("_at", cells.alias("_cells"))
    typed = body.select("_at", "_cells.*").select("_at", *[cell(f) for f in schema.fields])
    if not with_index:
        return typed.drop("_at")
    return typed.select(F.col("_at").alias("index"), *[q(n) for n in names])
