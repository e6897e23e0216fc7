"""Mixing overlapping sources to target weights.

A document may belong to several sources. Documents with the same set of sources form a pattern;
each pattern offers its words once at no cost and again at rising costs. A min-cost flow routes
them to the sources' quotas, and each pattern then gives seeded, whole documents.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, others, table, words
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

SEED = 7
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
# Documents of a pattern are put into this many slots by a seeded hash.
SLOTS = 1 << 16
# The slots at the cut are put together until they hold about so many documents.
CUT_DOCS = 1000


def target_words(
    sizes: Mapping[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MAX_COPIES,
) -> dict[str | None, float]:
    """Words each source should have in the mix.

    Sources by code point, NULL last, have the weights in turn and share ``share`` of all words.
    A target stops at ``most`` times its source; what is above goes to the others by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, targets = share * sum(sizes.values()), list(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / whole >= most * sizes[s]]
        if not full:
            return targets | {s: left * weight[s] / whole for s in open_}
        targets |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(
    capacity: Mapping[tuple, int], quotas: Mapping[str | None, int], copies: int = MAX_COPIES
) -> dict[tuple, int]:
    """Words that each pattern gives, by a min-cost flow.

    ``capacity``: words of each pattern, a tuple of sources. The k-th copy of a word costs k - 1,
    so no pattern repeats while another one with the same sources has unused words. The flow is
    the largest possible, and of those the cheapest; found along shortest paths with potentials.
    """
    patterns, sources = list(capacity), list(quotas)
    nodes = 2 + len(patterns) + len(sources)
    ends: list[list[int]] = [[] for _ in range(nodes)]
    edges: list[list[int]] = []  # [to, capacity left, cost]; the next one is its reverse

    def edge(a: int, b: int, room: int, cost: int) -> None:
        ends[a].append(len(edges))
        edges.append([b, room, cost])
        ends[b].append(len(edges))
        edges.append([a, 0, -cost])

    place = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    total = sum(quotas.values())
    for i, pattern in enumerate(patterns):
        for k in range(copies):
            edge(0, 2 + i, capacity[pattern], k)
        for s in pattern:
            if s in place:
                edge(2 + i, place[s], total, 0)
    for s in sources:
        edge(place[s], 1, quotas[s], 0)
    potential = [0] * nodes
    while True:
        cost: list[float] = [float("inf")] * nodes
        cost[0], via, queue = 0, [-1] * nodes, [(0, 0)]
        while queue:
            far, a = heapq.heappop(queue)
            if far > cost[a]:
                continue
            for e in ends[a]:
                b, room, price = edges[e]
                new = far + price + potential[a] - potential[b]
                if room and new < cost[b]:
                    cost[b], via[b] = new, e
                    heapq.heappush(queue, (new, b))
        if via[1] < 0:
            break
        potential = [p + c if c < float("inf") else p for p, c in zip(potential, cost)]
        path, at = [], 1
        while at:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        step = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= step
            edges[e ^ 1][1] += step
    first = {2 + i: pattern for i, pattern in enumerate(patterns)}
    given = dict.fromkeys(patterns, 0)
    for e in ends[0]:
        given[first[edges[e][0]]] += edges[e ^ 1][1]
    return given


def mix_plan(
    docs: DataFrame, doc_id: str, size: str, sources: str, seed: int = SEED,
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, copies: int = MAX_COPIES,
) -> DataFrame:
    """One row per pattern: ``_of_pattern``, ``_base``, ``_width``, ``_cut``, ``_chosen``,
    ``source_size`` and ``target`` (summed over the pattern's sources).

    Every document of the pattern is taken ``_base`` times, those in groups of slots before
    ``_cut`` once more, and in that group those whose keys are ``_chosen``. Documents without words
    are taken ``_base`` times only.

    What passes the driver is one row per pattern and per source.
    """
    slim = land(
        docs.select(
            _pattern(sources).alias("_pattern"), _key(doc_id, seed).alias("_key"),
            F.greatest(F.coalesce(q(size).cast("long"), F.lit(0)), F.lit(0)).alias("_size"),
        ),
        "sizes",
    )
    slots = land(
        slim.groupBy("_pattern", _slot().alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_docs"), F.sum("_size").alias("_words")),
        "slots",
    )
    rows = slots.groupBy("_pattern").agg(F.sum("_docs"), F.sum("_words")).collect()
    capacity = {tuple(json.loads(p)): w for p, _, w in rows}
    sizes: dict[str | None, int] = {}
    for pattern, n in capacity.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + n
    targets = target_words(sizes, weights, share, copies)
    given = route(capacity, {s: round(t) for s, t in targets.items()}, copies)
    planned = []
    for p, n, w in rows:
        pattern = tuple(json.loads(p))
        base = min(given[pattern] // w, copies) if w else 0
        planned.append(
            (p, base, given[pattern] - base * w if base < copies else 0,
             max(1, SLOTS * CUT_DOCS // n), sum(sizes[s] for s in pattern),
             float(sum(targets[s] for s in pattern)))
        )
    kinds = {
        "_of_pattern": pa.string(), "_base": pa.int64(), "_more": pa.int64(), "_width": pa.int64(),
        "source_size": pa.int64(), "target": pa.float64(),
    }
    # As a local table: of rows Spark would make an RDD, with Python workers of its own on each executor.
    columns = zip(*planned) if planned else [()] * len(kinds)
    plan = docs.sparkSession.createDataFrame(
        pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], names=list(kinds))
    )
    # Per pattern at most SLOTS rows are put in order, whatever the number of documents.
    before = (
        slots.join(F.broadcast(plan) if len(planned) < 10_000 else plan, F.col("_pattern") == F.col("_of_pattern"))
        .withColumn("_group", F.floor(F.col("_slot") / F.col("_width")))
        .groupBy("_of_pattern", "_group")
        .agg(F.sum("_words").alias("_words"), F.first("_more").alias("_more"))
        .withColumn(
            "_before",
            F.expr("sum(_words) OVER (PARTITION BY _of_pattern ORDER BY _group) - _words"),
        )
    )
    cut = before.where("_before <= _more AND _more < _before + _words").select(
        F.col("_of_pattern").alias("_cut_pattern"),
        F.col("_group").alias("_cut"),
        (F.col("_more") - F.col("_before")).alias("_room"),
    )
    plan = land(
        plan.join(cut, F.col("_of_pattern") == F.col("_cut_pattern"), "left").drop("_cut_pattern"),
        "plan",
    )
    edge = lookup_join(slim, plan, [("_pattern", "_of_pattern")]).where(_slot_group() == F.col("_cut"))
    chosen = (
        edge.where("_size > 0").groupBy("_of_pattern", "_key")
        .agg(F.sum("_size").alias("_size"), F.first("_room").alias("_room"))
        .groupBy(F.col("_of_pattern").alias("_chosen_pattern"))
        .applyInPandas(_fill, "_chosen_pattern string, _chosen array<long>")
    )
    return land(
        plan.join(chosen, F.col("_of_pattern") == F.col("_chosen_pattern"), "left")
        .drop("_chosen_pattern", "_more", "_room"),
        "mix",
    )


def _fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Takes documents in seeded order, each one that still fits."""
    rows = rows.sort_values("_key")
    room, taken = int(rows["_room"].iloc[0]), []
    for k, size in zip(rows["_key"], rows["_size"]):
        if size <= room:
            taken.append(k)
            room -= size
    return pd.DataFrame({"_chosen_pattern": [key[0]], "_chosen": [taken]})


def _pattern(sources: str):
    members = F.coalesce(q(sources), F.array().cast("array<string>"))
    return F.to_json(F.array_sort(F.array_distinct(members)), {"ignoreNullFields": "false"})


def _key(doc_id: str, seed: int):
    return F.xxhash64(q(doc_id).cast("string"), F.lit(seed))


def _slot():
    return F.pmod(F.col("_key"), F.lit(SLOTS))


def _slot_group():
    return F.floor(_slot() / F.col("_width"))


@any_names
def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", size: str = "size", sources: str = "sources",
    seed: int = SEED, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    copies: int = MAX_COPIES,
) -> DataFrame:
    """All rows of ``docs`` with ``copies``, ``source_size`` and ``target``.

    ``sources``: array of the sources a document belongs to; ``size``: its words. ``copies`` is how
    often the mix takes the document, 0 to ``copies`` times. The same rows and seed give the same
    result, however they are partitioned. Rows with the same id go together. A NULL size counts as 0; a row
    without words adds nothing to the mix and is taken as often as all rows with its sources are, but never
    once more to fill a target. A
    NULL in ``sources`` is a source of its own, a NULL array belongs to none and is not taken; an
    empty table gives an empty one. Columns named like the new ones are replaced.
    """
    made = ["copies", "source_size", "target"]
    plan = mix_plan(docs, doc_id, size, sources, seed, weights, share, copies)
    rows = docs.select(
        *others(docs, made), _pattern(sources).alias("_pattern"), _key(doc_id, seed).alias("_key"),
        q(size).cast("long").alias("_size"),
    )
    joined = lookup_join(rows, plan, [("_pattern", "_of_pattern")], "left")
    more = (_slot_group() < F.col("_cut")) | (
        (_slot_group() == F.col("_cut")) & F.array_contains("_chosen", F.col("_key"))
    )
    more = more & (F.col("_size") > 0)
    taken = F.coalesce(F.col("_base") + F.coalesce(more, F.lit(False)).cast("long"), F.lit(0))
    taken = F.least(taken, F.lit(copies))
    return joined.select(*others(docs, made), taken.alias("copies"), "source_size", "target")


def with_size(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``_words``, the size of its text, and ``_sources``, its one source."""
    return docs.withColumns(
        {"_words": F.size(words(q(text))).cast("long"), "_sources": F.array(q(source))}
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = land(with_size(docs).drop("text"), "documents")
    mixed = mix_sources(sized, size="_words", sources="_sources")
    return mixed.select(
        "doc_id", F.col("_words").alias("size"), "source_size", "target",
        (F.col("_words") * F.col("copies")).alias("taken"), "source",
    )
