"""The registered queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from salesloom.llm import (
    divergence,
    embed_dedup,
    html_extract,
    importance,
    lang_id,
    line_dedup,
    mixing,
    ngram_join,
    quality_rules,
    sharding,
    sp_codec,
    url_filter,
    weak_quality,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_mixing": mixing.op3_mixing,
        "op4_weak_quality": weak_quality.op4_weak_quality,
        "op5_sentencepiece": sp_codec.op5_sentencepiece,
        "op6_html_extract": html_extract.op6_html_extract,
        "op7_language_id": lang_id.op7_language_id,
        "op8_embedding_dedup": embed_dedup.op8_embedding_dedup,
        "op9_url_filter": url_filter.op9_url_filter,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_sharding": sharding.op11_sharding,
        "op12_importance": importance.op12_importance,
        "op13_divergence": divergence.op13_divergence,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op2_line_dedup": line_dedup.OP2_SQL,
        "op9_url_filter": url_filter.OP9_SQL,
        "op11_sharding": sharding.OP11_SQL,
        "op12_importance": importance.OP12_SQL,
        "op13_divergence": divergence.OP13_SQL,
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
