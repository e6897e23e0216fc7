"""JSON arrays of objects, in files of any size.

A file is read in pieces that end at a closing brace, so Spark can split it anywhere. Whether a piece begins inside
a string follows from how many quotes lie before it, and how deep it begins from the braces outside of strings.
Both are running sums: within blocks of pieces, on top of the totals of the blocks before. A piece that comes back
to depth 0 ends a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.operators.joins import lookup_join
from salesloom.operators.ordinal import with_file_position
from salesloom.scratch import land

# Pieces whose running sums one task makes. One number a block goes through a single task.
BLOCK = 65_536


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign)))


def _running(frame: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all pieces up to each one."""
    totals = land(frame.groupBy("_block").agg(F.sum(value).alias("_total")), "totals")
    before = F.expr("sum(_total) OVER (ORDER BY _block) - _total")
    bases = land(totals.select(F.col("_block").alias("_of"), before.alias("_base")), "bases")
    based = lookup_join(frame, bases, [("_block", "_of")])
    within = F.expr(f"sum({value}) OVER (PARTITION BY _block ORDER BY _at)")
    return based.select(*frame.columns, (F.col("_base") + within).alias(name))


def _marked(pieces: DataFrame, block: int) -> DataFrame:
    """Place, file, and what a piece does to quotes and depth if it begins outside or inside of a string."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*("|$)'
    return pieces.select(
        "_at", "_path", F.expr(f"_at div {int(block)}").alias("_block"),
        (_count(bare, '"') % 2).alias("_odd"),
        _count(F.regexp_replace(bare, strings, ""), "{").alias("_outside"),
        _count(F.regexp_replace(F.concat(F.lit('"'), bare), strings, ""), "{").alias("_inside"),
    )


def _closing(marks: DataFrame) -> DataFrame:
    """``_piece, _end, _head``: the piece that ends the record that each piece belongs to."""
    firsts = F.expr("min(_at) FILTER (WHERE _closes)")
    ends = land(marks.groupBy("_block").agg(firsts.alias("_first")), "ends")
    later = F.expr("min(_first) OVER (ORDER BY _block ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")
    following = land(ends.select(F.col("_block").alias("_of"), later.alias("_later")), "following")
    own = F.expr(
        "min(CASE WHEN _closes THEN _at END) OVER"
        " (PARTITION BY _block ORDER BY _at ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )
    joined = lookup_join(marks, following, [("_block", "_of")])
    found = joined.select(
        F.col("_at").alias("_piece"), F.coalesce(own, "_later").alias("_end"), "_head", "_last"
    )
    return found.where("NOT _last").drop("_last")


def array_records(spark: SparkSession, path: str | list[str], block: int = BLOCK) -> DataFrame:
    """``_record``: the text of each object of the arrays that the files hold, one array a file.

    An empty file or array gives no rows. A file that is no array of objects, or is cut short, raises
    ``ValueError``; something else than a comma between two objects stops the job. A record has to fit a task.

    All pieces are landed once to have numbers; texts are shuffled once, to put records together.
    """
    scan = spark.read.text(path, lineSep="}")
    pieces = with_file_position(scan.select("value", F.col("_metadata.file_path").alias("_path")), name="_at")
    marks = land(_marked(pieces, block), "marks")
    files = land(
        marks.groupBy("_path").agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
        .withColumnRenamed("_path", "_file"),
        "files",
    )
    quoted = _running(marks, "_odd", "_quotes")
    placed = lookup_join(quoted, files, [("_path", "_file")])
    inside = (F.col("_quotes") - F.col("_odd")) % 2 == 1
    last = F.col("_at") == F.col("_to")
    closed = (F.col("_quotes") % 2 == 0) & ~last
    step = F.when(inside, F.col("_inside")).otherwise(F.col("_outside")) - closed.cast("int")
    steps = land(
        placed.select(
            "_at", "_path", "_block", (F.col("_at") == F.col("_from")).alias("_head"), last.alias("_last"),
            closed.alias("_closed"), (F.col("_quotes") % 2 == 0).alias("_even"), step.alias("_step"),
        ),
        "steps",
    )
    deep = land(
        _running(steps, "_step", "_depth").withColumn("_closes", F.expr("_closed AND _depth = 0")), "depths"
    )
    unclosed = deep.where("_depth < 0 OR (_last AND (_depth <> 0 OR NOT _even))")
    tails = lookup_join(pieces.select("_at", "value"), files.select("_to", "_from"), [("_at", "_to")])
    tail = F.when(F.col("_at") == F.col("_from"), r"^\x{FEFF}?\s*(\[\s*\]\s*)?$").otherwise(r"^\s*\]\s*$")
    wrong = unclosed.select("_at").unionByName(tails.where(~F.regexp_like("value", tail)).select("_at")).limit(1).collect()
    if wrong:
        name = marks.where(F.col("_at") == wrong[0]["_at"]).first()["_path"]
        raise ValueError(f"no array of objects, or one that is cut short: {name}")
    members = land(_closing(deep), "members")
    joined = lookup_join(pieces, members, [("_at", "_piece")])
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda p: p["value"]), "}"
    )
    records = joined.groupBy("_end").agg(
        F.concat(text, F.lit("}")).alias("_text"), F.max("_head").alias("_head")
    )
    lead = F.regexp_extract("_text", r"^[^{]*", 0)
    right = F.when(F.col("_head"), r"^\x{FEFF}?\s*\[\s*$").otherwise(r"^\s*,\s*$")
    record = F.substr("_text", F.length(lead) + 1)
    message = F.concat(F.lit("unexpected text in an array: "), lead)
    return records.select(
        F.when(F.regexp_like(lead, right), record).otherwise(F.raise_error(message)).alias("_record")
    )


def read_array(
    spark: SparkSession, path: str | list[str], schema: StructType, block: int = BLOCK
) -> DataFrame:
    """Typed rows of :func:`array_records`, in no order. An object that does not fit the schema stops the job."""
    parsed = F.from_json("_record", schema, {"mode": "FAILFAST"})
    return array_records(spark, path, block).select(parsed.alias("_row")).select("_row.*")
