"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last one return the columns
of ``documents``. Between stages the frame is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm import lang_id, line_dedup, mixing, ngram_join, sp_codec
from salesloom.llm.common import table
from salesloom.scratch import land

# A document of which no language can be told with more than this is rejected.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that have no language: without letters, or with an undecided score."""
    scored = lang_id.identify(docs, lang_id.train(docs))
    told = (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return scored.where(told).select(*[q(c) for c in docs.columns])


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out of texts that are boilerplate of their source; ``n_chars`` follows.

    Copies of a text are one page of the source: they are for the next stage, and no boilerplate.
    """
    cleaned = line_dedup.drop_boilerplate(docs, "text", "source", copies=False)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(
        *[q(c) for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_join.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix_sources(mixing.with_size(docs), size="_words", sources="_sources")
    repeated = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[q(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of texts."""
    return sp_codec.encode(docs, sp_codec.Vocabulary.load(), keep_text=False).select(
        "doc_id", "lang", "source", "ids", "n_tokens", "lossless"
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Recurrent networks, seeded mixes and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
