"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or not at all on each document. Expectation-maximisation over
the counts of vote patterns estimates how accurate each one is, and so how likely a document of
each pattern is good. A linear scorer over hashed byte trigrams and votes learns those likelihoods.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.functions.columns import q
from salesloom.llm.common import map_arrow, others, table
from salesloom.scratch import land

BUCKETS = 1 << 15
#: Bound of the training sample: documents whose votes speak for good, and for bad.
DOCS_PER_SIDE = 1000
THRESHOLD = 0.25
SEED = 3
EPOCHS, RATE = 200, 1.0
#: What a vote counts for beside all of the trigrams together.
VOTE = 0.1
ABSTAIN, BAD, GOOD = 0, 1, 2

# Kinds of bytes.
_OTHER, _GAP, _UPPER, _LOWER, _DIGIT, _SYMBOL, _SHOUT, _INNER, _STOP = range(9)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x80:0xC0] = _INNER  # inside a character
_KIND[0xC0:] = _LOWER
for _chars, _kind in (
    (b" \t\n\v\f\r", _GAP), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
    (b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"0123456789", _DIGIT), (b"#*$%&|<>", _SYMBOL),
    (b"!", _SHOUT), (b".,;:?", _STOP),
):
    _KIND[list(_chars)] = _kind


@dataclass
class Measures:
    words: int
    word_length: float
    upper: float  # of letters
    digits: float  # per word
    symbols: float
    shouts: float
    stops: float
    letters: float  # of characters in words
    glued: float  # symbols that follow a letter or a stop, per word
    bare: float  # words that begin with a symbol
    repeated: float  # share of lines that equal an earlier one
    distinct: float  # different words, per word and at most 200
    twice: float  # share of words that equal the one before


def measure(text: str) -> Measures:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = _KIND[data]
    n = np.bincount(kinds, minlength=9)
    gap = kinds == _GAP
    words = int(np.count_nonzero(gap[:-1] & ~gap[1:])) + int(len(gap) > 0 and not gap[0])
    per = 1 / max(1, words)
    symbol = kinds[1:] == _SYMBOL
    glued = np.count_nonzero(symbol & ~gap[:-1] & (kinds[:-1] != _SYMBOL))
    bare = np.count_nonzero(symbol & gap[:-1]) + int(kinds[0] == _SYMBOL)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    tokens = text.split()
    letters = n[_UPPER] + n[_LOWER]
    return Measures(
        words, (len(data) - n[_GAP] - n[_INNER]) * per, n[_UPPER] / max(1, letters),
        n[_DIGIT] * per, n[_SYMBOL] * per, n[_SHOUT] * per, n[_STOP] * per,
        letters / max(1, len(data) - n[_GAP] - n[_INNER]), glued * per, bare * per,
        1 - len(set(lines)) / max(1, len(lines)),
        len(set(tokens)) / max(1, min(200, len(tokens))),
        sum(map(operator.eq, tokens, tokens[1:])) / max(1, len(tokens)),
    )


def _range(value: float, bad_below: float, good_from: float, good_to: float, bad_above: float) -> int:
    if value < bad_below or value > bad_above:
        return BAD
    return GOOD if good_from <= value <= good_to else ABSTAIN


NEVER = math.inf
#: One vote each.
LABELLERS: dict[str, Callable[[Measures], int]] = {
    "length": lambda m: _range(m.words, 5, 20, NEVER, NEVER),
    "word_length": lambda m: _range(m.word_length, 2.5, 3, 9, 12),
    "upper": lambda m: _range(m.upper, -1, 0, 0.15, 0.4),
    "digits": lambda m: _range(m.digits, -1, 0, 0.3, 1.5),
    "symbols": lambda m: _range(m.symbols, -1, 0, 0.1, 0.4),
    "shouts": lambda m: _range(m.shouts, -1, 0, 0.05, 0.3),
    "stops": lambda m: _range(m.stops, 0.01, 0.03, 0.6, 1.5),
    "letters": lambda m: _range(m.letters, 0.7, 0.8, NEVER, NEVER),
    "glued": lambda m: _range(m.glued, -1, 0, 0.05, 0.3),
    "bare": lambda m: _range(m.bare, -1, 0, 0.1, 0.3),
    "repeats": lambda m: _range(m.repeated, -1, 0, 0.05, 0.3),
    "distinct": lambda m: _range(m.distinct, 0.3, 0.5, NEVER, NEVER),
    "twice": lambda m: _range(m.twice, -1, 0, 0.1, 0.3),
}


def votes(text: str | None) -> int:
    """The vote pattern of a text as one number in base 3; -1 for a text without words."""
    if text is None or not text or text.isspace():
        return -1
    m, pattern = measure(text), 0
    for labeller in LABELLERS.values():
        pattern = pattern * 3 + labeller(m)
    return pattern


def unpack(patterns: np.ndarray, labellers: int = len(LABELLERS)) -> np.ndarray:
    """Votes of each pattern: rows x labellers."""
    return np.stack([patterns // 3**i % 3 for i in range(labellers - 1, -1, -1)], axis=1)


#: What is believed of every labeller before any vote is seen: chances to abstain, vote bad and vote
#: good on a bad and on a good document. It weighs as much as BELIEF times the documents.
BELIEVED = np.array([[0.15, 0.12, 0.73], [0.19, 0.01, 0.80]])
BELIEF = 0.1
GOOD_SHARE = 0.8


def expectation_maximisation(
    cast: np.ndarray, counts: np.ndarray, rounds: int = 500
) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of good for each pattern; each labeller's chances to abstain, vote bad and vote good on
    bad and on good documents (2 x labellers x 3); share of good documents.

    Labellers are independent given the class. The belief keeps rare defects that only one labeller sees from
    being taken for good documents on which that labeller errs.
    """
    seen = np.stack([cast == vote for vote in (ABSTAIN, BAD, GOOD)], axis=2).astype(float)
    chances = np.repeat(BELIEVED[:, None, :], cast.shape[1], axis=1)
    share, believed = GOOD_SHARE, BELIEF * counts.sum() + 1
    by_class = believed * np.array([1 - GOOD_SHARE, GOOD_SHARE])[:, None, None]
    chance = np.full(len(cast), share)
    for _ in range(rounds):
        log = np.einsum("pjv,cjv->cp", seen, np.log(chances))
        odds = log[0] + math.log(1 - share) - log[1] - math.log(share)
        before, chance = chance, 1 / (1 + np.exp(np.clip(odds, -50, 50)))
        weight = np.stack([counts * (1 - chance), counts * chance])
        summed = np.einsum("cp,pjv->cjv", weight, seen) + by_class * BELIEVED[:, None, :]
        chances = summed / summed.sum(axis=2, keepdims=True)
        share = float((weight[1].sum() + believed * GOOD_SHARE) / (counts.sum() + believed))
        if np.abs(chance - before).max() < 1e-9:
            break
    return chance, chances, share


def trigrams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Cell of each byte trigram of a text, its ends padded by a line break."""
    x = np.frombuffer(b"\n" + text.encode("utf-8", "replace") + b"\n", np.uint8).astype(np.uint32)
    packed = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    packed *= np.uint32(2654435761)
    packed >>= np.uint32(32 - buckets.bit_length() + 1)
    return packed


def vote_cells(pattern: int, buckets: int = BUCKETS) -> np.ndarray:
    """A cell for each labeller's vote, hashed into the same table."""
    cast = unpack(np.array([pattern]))[0]
    return (np.arange(len(cast)) * 3 + cast + 1) * 2654435761 % (1 << 32) % buckets


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        size = len(self.weights)
        x = self.bias + float(self.weights[trigrams(text, size)].mean(dtype=np.float64))
        x += VOTE * float(self.weights[vote_cells(votes(text), size)].sum())
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def fit(
    cells: list[np.ndarray], shares: list[np.ndarray], targets: np.ndarray, buckets: int = BUCKETS
) -> Scorer:
    """Logistic regression on soft targets; both sides weigh the same. ``shares``: of each cell."""
    column, value = np.concatenate(cells), np.concatenate(shares)
    row = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    importance = np.where(targets >= 0.5, 0.5 / max(1, (targets >= 0.5).sum()), 0.5 / max(1, (targets < 0.5).sum()))
    weights, bias = np.zeros(buckets), 0.0
    first, second = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for step in range(1, EPOCHS + 1):
        x = np.bincount(row, weights[column] * value, minlength=len(cells)) + bias
        error = (1 / (1 + np.exp(-np.clip(x, -50, 50))) - targets) * importance
        slope = np.append(np.bincount(column, error[row] * value, minlength=buckets), error.sum())
        slope[:-1] += 1e-7 * weights
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= 0.1 * move[-1]
    return Scorer(weights, bias)


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [votes(t.as_py()) for t in batch["_text"]]
        yield pa.record_batch([batch["_hash"], pa.array(found, pa.int64())], names=["hash", "pattern"])


def train(docs: DataFrame, text: str = "text", docs_per_side: int = DOCS_PER_SIDE) -> Scorer | None:
    """A scorer learned from all rows' votes; None if there is no text with words.

    Votes of all rows are counted; what the driver gets is one row per pattern, of which there are
    at most 3 to the number of labellers. The linear scorer is fitted on at most ``docs_per_side``
    texts of either side, the ones with the least hash of each slot, each as at most ``BUCKETS`` shares.
    """
    texts = docs.select(F.xxhash64(q(text), F.lit(SEED)).alias("_hash"), q(text).alias("_text"))
    cast = texts.mapInArrow(_vote_rows, "hash long, pattern long").where("pattern >= 0")
    slots = cast.groupBy("pattern", F.pmod("hash", F.lit(docs_per_side)).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min("hash").alias("least")
    )
    slots = land(slots, "votes")
    counted = slots.groupBy("pattern").agg(F.sum("n")).collect()
    if not counted:
        return None
    patterns = np.array([r[0] for r in counted], np.int64)
    chance, _, _ = expectation_maximisation(unpack(patterns), np.array([r[1] for r in counted], float))
    known = docs.sparkSession.createDataFrame(
        [(int(p), float(c)) for p, c in zip(patterns, chance)], "_pattern long, chance double"
    )
    picked = slots.join(known, F.col("pattern") == F.col("_pattern")).groupBy(
        "slot", (F.col("chance") >= 0.5).alias("side")
    ).agg(F.min_by("chance", "least").alias("chance"), F.min("least").alias("_least"))
    sample = (
        texts.join(F.broadcast(picked.select("_least", "chance")), F.col("_hash") == F.col("_least"))
        .select("_hash", "chance", "_text")
        .mapInArrow(_share_rows, "hash long, chance double, cells array<int>, shares array<float>")
        .dropDuplicates(["hash"]).collect()
    )
    sample.sort(key=lambda r: r[0])
    return fit(
        [np.array(r[2], np.int64) for r in sample], [np.array(r[3]) for r in sample],
        np.array([r[1] for r in sample]),
    )


def _share_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch["_text"][i].as_py()
            cells, n = np.unique(trigrams(text), return_counts=True)
            cast = vote_cells(votes(text))
            shares = np.concatenate([n / n.sum(), np.full(len(cast), VOTE)])
            yield pa.record_batch({
                "hash": batch["_hash"][i : i + 1], "chance": batch["chance"][i : i + 1],
                "cells": pa.array([np.concatenate([cells, cast]).astype(np.int32)]),
                "shares": pa.array([shares.astype(np.float32)]),
            })


def classify(docs: DataFrame, scorer: Scorer | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows of ``docs`` with ``score``, the chance that the text is good, and ``kept``.

    Whole texts are scored. Texts without words, and NULL, score 0 and are not kept; without a
    scorer nothing is known and all others score 1. Repeated rows score alike; an empty table gives an
    empty one. Columns named like the new ones are replaced.
    """
    made = StructType().add("score", "double").add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for value in batch["_text"]:
                t = value.as_py()
                if not t or t.isspace():
                    scores.append(0.0)
                else:
                    scores.append(scorer.score(t) if scorer else 1.0)
            kept = pa.array([s >= threshold and s > 0 for s in scores])
            yield pa.record_batch([batch["_row"], pa.array(scores, pa.float64()), kept], names=["_row", "score", "kept"])

    return map_arrow(docs, others(docs, made.names), [q(text).alias("_text")], run, made)


def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, train(docs)).drop("text")
