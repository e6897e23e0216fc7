"""Importance resampling towards a target distribution.

Texts become bags of hashed word n-grams. Each bucket gains the log ratio of its share in the target
to its share in the corpus; a document weighs the sum of its gains. With seeded Gumbel noise added,
the highest scores are a sample drawn without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salesloom.functions.columns import q
from salesloom.llm.bytewords import byte_table, word_pieces
from salesloom.llm.common import any_names, map_arrow, others, small_batches, table
from salesloom.llm.sharding import CRC_SQL
from salesloom.operators.ordinal import with_ordinal
from salesloom.scratch import land

BUCKETS = 10_000
SEED = 42
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Percent of the other documents that are drawn.
PERCENT = 5
#: Words are runs of digits, letters and all that is beyond ASCII.
TABLE = byte_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)

_MADE = ["n_features", "n_words", "weight", "score", "rank"]


def feature_hashes(text: bytes | None) -> Iterator[tuple[int, list[int]]]:
    """Number of words and the CRC-32 of all runs of one to three words, piece by piece.

    A run's hash goes on from the one that lacks its last word, so no run is put together. The
    last two words of a piece are carried on, so runs across a cut are found once.
    """
    carried: list[bytes] = []
    for words in word_pieces(text, TABLE):
        old = len(carried)
        words = carried + words
        spaced = [b" " + w for w in words]
        one = list(map(crc32, words))
        two = list(map(crc32, spaced[1:], one))
        three = map(crc32, spaced[2:], two)
        yield len(words) - old, list(chain(one[old:], two[max(old - 1, 0) :], three))
        carried = words[-2:]


def _counts(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch["_text"]:
                for _, hashes in feature_hashes(text.as_py()):
                    counts.update((np.array(hashes, np.int64) % buckets).tolist())
        cells = sorted(counts)
        yield pa.record_batch(
            {"bucket": pa.array(cells, pa.int64()), "n": pa.array([counts[c] for c in cells], pa.int64())}
        )

    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket.

    Each task adds up its rows in one counter; tasks' counters are added up by bucket. What passes
    the driver are at most ``buckets`` numbers.
    """
    small_batches(texts.sparkSession)
    found = (
        texts.select(_data(text)).mapInArrow(_counts(buckets), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(buckets, np.int64)
    for bucket, n in found:
        out[bucket] = n
    return out


def _data(text: str) -> Column:
    return q(text).cast("string").cast("binary").alias("_text")


def bucket_gains(corpus: Sequence[int], target: Sequence[int]) -> np.ndarray:
    """``floor(1000 * ln(share in the target / share in the corpus))``, one more in each bucket."""
    n, total, wanted = len(corpus), int(sum(corpus)), int(sum(target))
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * (total + n) / (float(s + 1) * (wanted + n))))
            for s, t in zip(map(int, corpus), map(int, target))
        ],
        np.int64,
    )


def noise(doc_id: str, seed: int) -> int:
    """Thousandths of Gumbel noise, by a digest of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gains: np.ndarray, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {name: np.zeros(batch.num_rows, np.int64) for name in _MADE[:-1]}
            for i, (text, doc_id) in enumerate(zip(batch["_text"], batch["_id"])):
                n_words = n_features = weight = 0
                for n, hashes in feature_hashes(text.as_py()):
                    n_words += n
                    n_features += len(hashes)
                    weight += int(gains[np.array(hashes, np.int64) % len(gains)].sum())
                values = n_features, n_words, weight, weight + noise(doc_id.as_py(), seed)
                for column, value in zip(made.values(), values):
                    column[i] = value
            yield pa.record_batch(
                [batch["_row"], *(pa.array(c) for c in made.values())], names=["_row", *made]
            )

    return run


def importance_scores(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """All rows of ``docs`` with ``n_features``, ``n_words``, ``weight`` and ``score`` (all long).

    Words are runs of digits, letters and characters beyond ASCII, only A-Z lower-cased; features are all
    runs of one to three words, repeats counted. Whole texts count, both here and in the bucket counts,
    whatever their length: long ones are taken in pieces. A NULL or empty text has no features and weight 0; a NULL id
    reads as the empty text in the noise. Repeated rows score alike. An empty target gives gains by the corpus alone; empty
    tables give empty ones. Columns named like the new ones are replaced.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    inputs = [_data(text), F.coalesce(q(doc_id).cast("string"), F.lit("")).alias("_id")]
    schema = StructType([StructField(n, LongType()) for n in _MADE[:-1]])
    return map_arrow(docs, others(docs, _MADE), inputs, _weigh(gains, seed), schema)


@any_names
def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """All rows of ``docs`` but for the text, with the columns of :func:`importance_scores` and ``rank``.

    Of the N rows with at least ``least_words`` words, the ``percent * N // 100`` highest scores have the ranks 1, 2, 3, ...;
    equal scores go by the smaller id, NULL ids last. Other rows have no rank. Rows that are alike in score and id
    are ranked in any order of their content. For the rest see :func:`importance_scores`.

    Scores are landed, and ranks come from range partitions: no window or sort in one task, however
    many rows share a score. The text is left out, since rows are sorted; join it back by id.
    """
    scored = importance_scores(docs, target, doc_id, text, target_text, buckets, seed)
    kept = [q(c) for c in docs.columns if c.lower() not in {n.lower() for n in (*_MADE, text)}]
    scored = land(
        scored.select(
            F.struct(*kept, F.lit(0).alias("_pad")).alias("_kept"),
            *_MADE[:-1], (-F.col("score")).alias("_down"),
            q(doc_id).isNull().alias("_no_id"), q(doc_id).alias("_tie"),
        ),
        "scored",
    )
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    ranked = with_ordinal(scored.where(able), ["_down", "_no_id", "_tie"], start=1, name="_place")
    rank = F.when(F.col("_place") <= drawn, F.col("_place").cast("long"))
    out = ["_kept.*", *_MADE[:-1]]
    rest = scored.where(~able).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank.alias("rank")).union(rest).drop("_pad")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"))


OP12_SQL = "WITH " + CRC_SQL.strip() + r""",
texts AS (
  SELECT doc_id, 0 AS part, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT row_number() OVER (), 1, coalesce(text, '') FROM benchmark
), split AS (
  SELECT doc_id, part, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), words AS (
  SELECT doc_id, part, unnest(w) AS word, unnest(range(len(w))) AS place FROM split
), runs AS (
  SELECT doc_id, part, word AS a, lead(word) OVER following AS b, lead(word, 2) OVER following AS c FROM words
  WINDOW following AS (PARTITION BY part, doc_id ORDER BY place)
), features AS (
  SELECT doc_id, part, a AS feature FROM runs
  UNION ALL SELECT doc_id, part, a || ' ' || b FROM runs WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, part, a || ' ' || b || ' ' || c FROM runs WHERE c IS NOT NULL
), bytes AS (
  SELECT feature, list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda x: ('0x' || x)::UBIGINT) AS y
  FROM (SELECT DISTINCT feature FROM features)
), hashed AS (
  SELECT feature, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, y),
    lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::BIGINT]))) % 10000 AS bucket FROM bytes, crc_table
), counts AS (
  SELECT bucket, count(*) FILTER (part = 0) AS s, count(*) FILTER (part = 1) AS t
  FROM features JOIN hashed USING (feature) GROUP BY bucket
), sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM counts, sums
), weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS weight
  FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE part = 0 GROUP BY doc_id
), scores AS (
  SELECT split.doc_id, coalesce(n_features, 0) AS n_features, len(w) AS n_words, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || split.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights ON split.doc_id = weights.doc_id WHERE part = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r,
    count(*) FILTER (n_words >= 20) OVER () AS n FROM scores
)
SELECT doc_id, n_features::BIGINT AS n_features, n_words::BIGINT AS n_words, weight, score,
  CASE WHEN n_words >= 20 AND r <= 5 * n // 100 THEN r END AS rank FROM ranked
"""
