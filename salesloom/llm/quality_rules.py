"""Quality rules in DataFrame functions: text measures and a hashed n-gram likelihood ratio.

Words and word pairs are hashed into ``buckets`` cells. Two multinomials over the cells are counted
over all rows: one from trusted documents, one from the raw corpus. A document's score is the mean
of log(trusted / raw) over its n-grams, and a fixed threshold decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, others, table, words
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

BUCKETS = 1 << 16
#: Added to every cell's count.
SMOOTHING = 1.0
#: Mean log ratio a document must reach.
THRESHOLD = -0.12
# Low bits of a sort key that hold a word position: 16 million words, more than an array can have.
_POSITION = (1 << 24) - 1
_MADE = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
    "kept",
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though ``body`` uses it within loops."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hashes(text: Column) -> Column:
    """64-bit hash of each word."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def ngram_cells(word_hashes: Column, buckets: int) -> Column:
    """Cells of all words and word pairs of a document, repeats included."""

    def cells(h: Column) -> Column:
        single = F.transform(h, lambda a: F.pmod(a, F.lit(buckets)).cast("int"))
        pair = F.transform(
            F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
            lambda b, i: F.pmod(F.xxhash64(F.get(h, i), b), F.lit(buckets)).cast("int"),
        )
        return F.concat(single, F.when(F.size(h) > 1, pair).otherwise(F.array().cast("array<int>")))

    return let(word_hashes, cells)


def repeated_words(word_hashes: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more in the text."""

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1), p + 3) - p),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def places(windows: Column, keys: Column) -> Column:
        def window(key: Column) -> Column:
            return F.get(windows, key.bitwiseAND(F.lit(_POSITION)).cast("int"))

        found = F.transform(
            keys,
            lambda k, i: F.when(
                (window(k) == window(F.get(keys, i + 1)))
                | ((i > 0) & (window(k) == window(F.get(keys, F.greatest(i - 1, F.lit(0)))))),
                k.bitwiseAND(F.lit(_POSITION)),
            ),
        )
        return F.array_sort(F.array_compact(found))

    def count(windows: Column) -> Column:
        # Sorted by hash, equal windows are neighbours; the low bits say where each one begins.
        keys = F.sort_array(
            F.transform(
                windows,
                lambda t, i: t.bitwiseAND(F.lit(~_POSITION)).bitwiseOR(i.cast("long")),
            )
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(let(keys, lambda k: places(windows, k)), covered)
        )

    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, 3, F.greatest(F.size(h) - 2, F.lit(0))),
            lambda c, i: F.xxhash64(F.get(h, i), F.get(h, i + 1), c),
        )

    return F.when(F.size(word_hashes) < 3, F.lit(0)).otherwise(
        let(let(word_hashes, windows), count)
    ).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def symbols(text: Column) -> Column:
    """Characters of ``#*$%&|<>``."""
    kept = F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return F.coalesce(F.length(text) - kept, F.lit(0)).cast("long")


def log_ratios(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, smoothing: float = SMOOTHING,
) -> DataFrame:
    """One row per cell: ``cell`` and ``ratio``, log(trusted share / raw share).

    ``trusted`` has the ids of trusted documents in its column ``doc_id``. Counts are over all
    rows, added up in each task before they are shuffled, and landed, so that the corpus is
    counted once. Without trusted n-grams all ratios are 0.
    """
    ids = trusted.select(q(doc_id).alias("_trusted")).where("_trusted IS NOT NULL").distinct()
    marked = lookup_join(
        docs.select(q(doc_id).alias("_id"), q(text).alias("_text")), ids, [("_id", "_trusted")], "left"
    )
    counts = (
        marked.select(
            F.explode(ngram_cells(hashes(F.col("_text")), buckets)).alias("cell"),
            F.col("_trusted").isNotNull().alias("_good"),
        )
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("_raw"), F.count_if("_good").alias("_good"))
    )
    counts = land(counts, "cells")
    cells = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    filled = cells.join(counts, "cell", "left").select(
        "cell", *[(F.coalesce(c, F.lit(0)) + F.lit(smoothing)).alias(c) for c in ("_raw", "_good")]
    )
    total = filled.agg(F.sum("_raw").alias("_raw"), F.sum("_good").alias("_good"))
    raw, good = (total.select(c).scalar() for c in ("_raw", "_good"))
    ratio = F.log(F.col("_good") / good) - F.log(F.col("_raw") / raw)
    return filled.select("cell", F.when(good > smoothing * buckets, ratio).otherwise(0.0).alias("ratio"))


@any_names
def quality_rules(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows of ``docs`` with measures, ``base_failed``, ``score`` and ``kept``.

    ``n_words``; ``word_chars``: code points in words; ``n_symbols``; ``n_dup_lines``;
    ``n_repeat_words``. ``base_failed``: under 50 words, or more than half of them repeated.
    ``kept``: not ``base_failed`` and ``score >= threshold``.

    NULL and empty texts have zeros, score 0 and fail; repeated rows are judged alike; an empty
    table gives an empty one; columns named like the new ones are replaced. No row is left out
    of the counts. What passes the driver is one array of ``buckets`` ratios.
    """
    ratios = log_ratios(docs, trusted, doc_id, text, buckets, smoothing)
    # One row of fixed size, put into the plan as a scalar.
    row = ratios.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cell", "ratio"))), lambda x: x["ratio"])
        .alias("ratios")
    ).scalar()
    kept = others(docs, _MADE)
    rows = docs.select(*kept, q(text).alias("_text"))
    measured = rows.select(
        "*",
        F.length(F.array_join(words(F.col("_text")), "")).cast("long").alias("word_chars"),
        symbols(F.col("_text")).alias("n_symbols"),
        duplicate_lines(F.col("_text")).alias("n_dup_lines"),
        hashes(F.col("_text")).alias("_hashes"),
        row.alias("_ratios"),
    )
    score = let(
        F.col("_ratios"),
        lambda r: F.aggregate(
            F.transform(ngram_cells(F.col("_hashes"), buckets), lambda c: F.get(r, c)),
            F.lit(0.0),
            lambda total, x: total + x,
        ),
    )
    n = F.size("_hashes").cast("long")
    scored = measured.select(
        "*",
        n.alias("n_words"),
        repeated_words(F.col("_hashes")).alias("n_repeat_words"),
        F.when(n > 0, score / (2 * n - 1)).otherwise(0.0).alias("score"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        *kept, *[c for c in _MADE if c not in ("base_failed", "kept")],
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= threshold)).alias("kept"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted: documents labelled as good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules(docs, trusted).drop("text")
