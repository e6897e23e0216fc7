"""Line dedup by site-relative frequency.

For each site, the share of its pages that contain a line; lines above a ratio are boilerplate of
that site and are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, others, table
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

#: A line is dropped if more than this share of its site's pages contain it ...
RATIO = 0.01
#: ... and at least so many pages do.
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _line_key(line: Column) -> Column:
    """Hash of a line without blanks around it; NULL for a blank line."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(
    pages: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, copies: bool = True,
) -> DataFrame:
    """``_of_host`` and ``_boilerplate``, hashes of the lines to drop on that host.

    A page counts a line once; without ``copies``, pages of a host with one text are one page. Counts are added up in each task before the shuffle, so a host with
    a third of all pages is no hot key. A host has at most lines of a page / ratio entries.
    """
    seen = F.array_compact(F.array_distinct(F.transform(_lines(q(text)), _line_key)))
    counts = pages.select(
        _host_key(host).alias("_host"), seen.alias("_seen"),
        *([] if copies else [F.xxhash64(q(text)).alias("_text"), F.length(q(text)).alias("_length")]),
    )
    if not copies:
        counts = counts.groupBy("_host", "_text", "_length").agg(F.first("_seen").alias("_seen"))
    counted = land(
        # One NULL more for each page counts the pages.
        counts.select(
            "_host", F.explode(F.concat("_seen", F.array(F.lit(None).cast("long")))).alias("_line")
        )
        .groupBy("_host", "_line")
        .agg(F.count(F.lit(1)).alias("_n")),
        "lines",
    )
    totals = counted.where("_line IS NULL").select(F.col("_host").alias("_total_of"), F.col("_n").alias("_pages"))
    often = counted.where(f"_line IS NOT NULL AND _n >= {int(min_pages)}")
    return (
        # Salted where a host has very many frequent lines; only what stays is put together by host.
        lookup_join(often, totals, [("_host", "_total_of")])
        .where(F.col("_n") > F.col("_pages") * F.lit(float(ratio)))
        .groupBy(F.col("_host").alias("_of_host"))
        .agg(F.collect_list("_line").alias("_boilerplate"))
    )


def _host_key(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("h"), q(host).cast("string")), F.lit(""))


@any_names
def drop_boilerplate(
    pages: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, copies: bool = True,
) -> DataFrame:
    """All rows of ``pages`` with boilerplate lines taken out of ``text``; ``n_lines``, ``n_dropped``.

    ``n_lines`` counts the lines that are not blank, ``n_dropped`` those dropped. The lines that
    stay keep their order and form. A NULL text stays NULL with counts 0; pages with a NULL host
    are a host of their own; rows with one text count as several pages, or without ``copies`` as one page
    of their host; a text of which all is dropped becomes empty; an empty table gives an empty one. Columns named like the two counts are replaced.
    """
    made = ["n_lines", "n_dropped"]
    found = boilerplate(pages, text, host, ratio, min_pages, copies)
    rows = pages.select(*others(pages, made), _host_key(host).alias("_host"))
    joined = lookup_join(rows, found, [("_host", "_of_host")], "left")
    drop = F.coalesce("_boilerplate", F.array().cast("array<long>"))
    # Keys once per line; a blank line has none and stays.
    marked = F.transform(
        _lines(q(text)),
        lambda line: F.struct(line.alias("line"), _line_key(line).alias("key")),
    )
    kept = F.filter(
        "_marked", lambda x: x["key"].isNull() | ~F.array_contains("_drop", x["key"])
    )
    columns = [
        F.when(q(text).isNotNull(), F.array_join(F.transform("_kept", lambda x: x["line"]), "\n")).alias(c)
        if c.lower() == text.lower() else q(c)
        for c in pages.columns if c.lower() not in made
    ]
    return (
        joined.withColumns({"_marked": marked, "_drop": drop})
        .withColumn("_kept", kept)
        .select(
            *columns,
            F.size(F.filter("_marked", lambda x: x["key"].isNotNull())).cast("long").alias("n_lines"),
            (F.size("_marked") - F.size("_kept")).cast("long").alias("n_dropped"),
        )
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source: the source is the site."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return drop_boilerplate(docs).drop("source")


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS place FROM documents WHERE text IS NOT NULL
), bare AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS b FROM lines
), pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source
), often AS (
  SELECT bare.source, b, count(DISTINCT doc_id) AS n FROM bare WHERE b <> '' GROUP BY ALL
), drops AS (
  SELECT often.source, b FROM often JOIN pages ON often.source IS NOT DISTINCT FROM pages.source
  WHERE often.n >= 5 AND often.n > pages.n * 0.01::double
), marked AS (
  SELECT bare.*, drops.b IS NOT NULL AS gone FROM bare LEFT JOIN drops
    ON bare.source IS NOT DISTINCT FROM drops.source AND bare.b = drops.b
), back AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
    count(*) FILTER (b <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, back.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN back ON d.doc_id = back.doc_id
"""
