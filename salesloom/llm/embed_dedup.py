"""Embedding near-dedup by cross-polytope hashing.

A vector is rotated at random (sign flips and fast Hadamard transforms) and hashed to the axis it
lies nearest to. Several such hashes make a table's bucket; several tables make the index. Each
vector lies in its home bucket and also probes the buckets of the next-best axis. Who meets in a
bucket with a near sketch is verified by cosine.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, others, table
from salesloom.llm.components import components
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

LEAST_COSINE = 0.98
SEED = 11
#: A bucket should hold about this many vectors; more vectors get longer hashes.
BUCKET_VECTORS = 32
#: Chance that a link at the least cosine meets in no table.
MISSES = 1e-5
# Measured for cosine 0.98: the nearest axis agrees; it agrees or is the other's second one.
AGREE, NEARLY = 0.73, 0.94
# A larger bucket is compared block by block.
BLOCK = 512
# Rows of a unit on its left side, on its right side, on both.
HOME, PROBE_ONLY, BOTH = 0, 1, 2
#: Bits of the sketch that stands for a vector until it is near another's.
BITS = 128


def index_shape(vectors: int, dimension: int) -> tuple[int, int]:
    """Hashes per table and tables for so many vectors.

    A pair meets in a table if all its hashes agree, or all but one that agrees with a probe.
    """
    axes = 2 * _padded(dimension)
    hashes = max(1, math.ceil(math.log(max(1.0, vectors / BUCKET_VECTORS)) / math.log(axes)))
    meets = AGREE**hashes + hashes * AGREE ** (hashes - 1) * (NEARLY - AGREE)
    return hashes, max(2, math.ceil(math.log(MISSES) / math.log(1 - meets)))


def _padded(dimension: int) -> int:
    return 1 << max(1, (max(1, dimension) - 1).bit_length())


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2)
        x = x.reshape(len(x), n)
        step *= 2
    return x


def codes(vectors: np.ndarray, hashes: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Buckets of each vector: rows x tables x (home, then one probe per hash)."""
    n, dimension = vectors.shape
    wide = _padded(dimension)
    padded = np.zeros((n, wide))
    padded[:, :dimension] = vectors
    rng = np.random.default_rng([seed, dimension])
    out = np.empty((n, tables, 1 + hashes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, second = [], []
        for _ in range(hashes):
            x = padded
            for _ in range(3):
                x = _hadamard(x * rng.choice([-1.0, 1.0], wide)) / math.sqrt(wide)
            size = np.abs(x)
            for found in (best, second):
                axis = size.argmax(axis=1)
                found.append(2 * axis + (x[rows, axis] < 0))
                size[rows, axis] = -1
        for probe in range(-1, hashes):
            code = np.zeros(n, np.int64)
            for i in range(hashes):
                code = code * (2 * wide) + (second if i == probe else best)[i]
            out[:, t, 1 + probe] = code
    return out


def sketch(vectors: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Sides of ``BITS`` random planes that each vector lies on, as rows of bytes."""
    planes = np.random.default_rng([seed, vectors.shape[1], BITS]).normal(size=(vectors.shape[1], BITS))
    return np.packbits(vectors @ planes > 0, axis=1)


def most_bits(least: float) -> int:
    """Bits of a sketch that a link may differ in: seven deviations above the mean, less than 1e-8 beyond."""
    share = math.acos(min(1.0, max(-1.0, least))) / math.pi
    return math.ceil(BITS * share + 7 * math.sqrt(BITS * share * (1 - share)) + 2)


def _hash_rows(hashes: int, tables: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["vector"]
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            out = np.zeros((batch.num_rows, tables * (1 + hashes)), np.int64)
            bits = np.zeros((batch.num_rows, BITS // 8), np.uint8)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = flat[begins[rows][:, None] + np.arange(size)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of huge values stay finite
                out[rows] = codes(x, hashes, tables).reshape(len(rows), -1)
                bits[rows] = sketch(x)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1) * out.shape[1], pa.int32()), pa.array(out.ravel())
            )
            yield pa.record_batch(
                [batch["node"], batch["part"], pa.array(list(map(bytes, bits)), pa.binary()), lists],
                names=["node", "part", "bits", "codes"],
            )

    return run


def _units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` as tables of whole units, with the rows at which units begin.

    A unit may run over batches; what is held is one batch and the rows of its last unit.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        begins = _begins(rows, keys)
        last = int(begins[-1])
        if last:
            yield rows.slice(0, last), begins[:-1]
        held = rows.slice(last).to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, _begins(rows, keys)


def _begins(rows: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        value = rows[key].to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def _candidates(most: int) -> Callable:
    """Who of a bucket may link, by sketches: rows of a pair of blocks and a node of one of them.

    There are no pairs of nodes: a node that may link with any number of others of a block is one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in _units(batches, ["unit"]):
            node, block, role = (rows[c].to_numpy() for c in ("node", "block", "role"))
            bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(len(node), -1)
            out = []
            for start, end in zip(begins, [*begins[1:], len(node)]):
                if end - start > 1:
                    at = np.arange(start, end)
                    _candidates_of(at[role[at] != PROBE_ONLY], at[role[at] != HOME], node, block, bits, most, out)
            if out:
                one, other, who = (np.concatenate(x) for x in zip(*out))
                yield pa.record_batch({
                    "lo": pa.array(np.minimum(one, other)), "hi": pa.array(np.maximum(one, other)),
                    "node": pa.array(who),
                })

    return run


def _candidates_of(left, right, node, block, bits, most: int, out: list) -> None:
    if not len(left) or not len(right):
        return
    a, b = (2 * np.unpackbits(bits[x], axis=1).astype(np.float32) - 1 for x in (left, right))
    near = (a @ b.T >= BITS - 2 * most) & (node[left][:, None] != node[right][None, :])
    if not near.any():
        return
    near = near.astype(np.float32)
    for these, those, close in ((left, right, near), (right, left, near.T)):
        names, of = np.unique(block[those], return_inverse=True)
        member = np.zeros((len(those), len(names)), np.float32)
        member[np.arange(len(those)), of] = 1
        i, j = np.nonzero(close @ member)
        out.append((block[these[i]], names[j], node[these[i]]))


def _verify(least: float) -> Callable:
    """Compares the vectors of each pair of blocks, once: other rows linked, and the least node reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in _units(batches, ["lo", "hi"]):
            node, weight, part, block, lo = (rows[c].to_numpy() for c in ("node", "weight", "part", "block", "lo"))
            hi = rows["hi"].to_numpy()
            column = rows["vector"].combine_chunks()
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            out = []
            for start, end in zip(begins, [*begins[1:], len(node)]):
                for size in np.unique(sizes[start:end]):
                    at = start + np.flatnonzero(sizes[start:end] == size)
                    x = flat[places[at][:, None] + np.arange(size)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                    i = np.flatnonzero(block[at] == lo[start])
                    j = np.flatnonzero(block[at] == hi[start])
                    near = (x[i] @ x[j].T >= least) & (part[at[i]][:, None] == part[at[j]][None, :])
                    if lo[start] == hi[start]:
                        near[np.arange(len(i)), np.arange(len(i))] = False
                    _count(at, i, j, near, lo[start] != hi[start], node, weight, out)
            if out:
                ids, linked, roots = (np.concatenate(x) for x in zip(*out))
                yield pa.record_batch({"node": pa.array(ids), "linked": pa.array(linked), "root": pa.array(roots)})

    return run


def _count(at, i, j, near, two_blocks: bool, node, weight, out: list) -> None:
    x, y = np.nonzero(near)
    if not len(x):
        return
    linked = np.zeros(len(at), np.int64)
    np.add.at(linked, i[x], weight[at[j[y]]])
    if two_blocks:
        np.add.at(linked, j[y], weight[at[i[x]]])
    ids = node[at]
    root = _roots(i[x], j[y], ids)
    said = linked > 0
    out.append((ids[said], linked[said], root[said]))


def _roots(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that each row of a unit reaches by the unit's links."""
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (before == root).all():
            return root


@any_names
def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = LEAST_COSINE,
) -> DataFrame:
    """All rows with ``n_links``, ``component_id`` and ``kept``.

    Rows with the same label link if the cosine of their vectors, in double precision, is at
    least ``least``. ``n_links``: other rows linked directly; ``component_id``: least id reachable;
    ``kept``: it is the row's own. Rows whose label or vector is NULL, and vectors that are empty,
    zero, of another length or have a NULL or non-finite component link with nothing. Equal vectors are one
    class and are compared once; repeated rows are linked rows. A NULL id has no component, is not kept
    and links with nothing. An empty table gives an empty one. Columns named like the new ones are replaced.

    All links found are real; links are missed at most with the chance ``MISSES`` set for the index. What is
    dealt to buckets is a node and a sketch of its vector. Nodes whose sketches are near give pairs of blocks; a
    block is a part of a home bucket of the first table. The vectors that such a pair of blocks needs travel to it
    once, however often they meet, and each pair of vectors is compared in one place. Crowded buckets and
    blocks are cut, so that no task holds a large one, and a pair of blocks sends on counts and one root per row.
    """
    spark, made = rows.sparkSession, ["n_links", "component_id", "kept"]
    keep = others(rows, made)
    value = q(vector)
    usable = (
        q(vec_id).isNotNull() & q(label).isNotNull() & (F.size(value) > 0)
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(value, lambda x: x != 0)
    )
    parts = F.xxhash64(q(label), value), F.xxhash64(value, F.lit(SEED), q(label))
    key = F.when(usable, F.concat_ws(" ", *parts))  # 128 bits stand for label and vector
    own = rows.select(*keep, key.alias("_key"))
    classes = (
        rows.where(usable)
        .select(key.alias("_class"), q(vec_id).alias("_id"), value.alias("_v"), q(label).alias("_l"))
        .groupBy("_class")
        .agg(
            F.min("_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
            F.first("_v").alias("vector"), F.first("_l").alias("_l"),
        )
        .withColumn("part", F.xxhash64("_l", F.size("vector")))
        .withColumn("node", F.monotonically_increasing_id())  # fixed by landing; ids may repeat
    )
    classes = land(classes.drop("_l"), "classes")
    shape = classes.groupBy("part", F.size("vector").alias("d")).count().agg(
        F.max("count"), F.max("d")
    ).first()
    hashes, tables = index_shape(shape[0] or 1, shape[1] or 1)
    hashed = land(
        classes.select("node", "part", "vector").mapInArrow(
            _hash_rows(hashes, tables), "node long, part long, bits binary, codes array<long>"
        ), "hashed"
    )
    blocks, units = _blocks_and_units(hashed, 1 + hashes)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (
        units.repartition(n, "unit").sortWithinPartitions("unit")
        .mapInArrow(_candidates(most_bits(least)), "lo long, hi long, node long")
    )
    pairs = land(met.distinct(), "pairs")
    vectors = classes.select(F.col("node").alias("_node"), "weight", "vector", "part")
    placed = lookup_join(vectors, blocks.select(F.col("node").alias("_of"), "block"), [("_node", "_of")])
    needed = lookup_join(pairs, placed.drop("_of"), [("node", "_node")]).drop("_node")
    found = land(
        needed.repartition(n, "lo", "hi").sortWithinPartitions("lo", "hi")
        .mapInArrow(_verify(least), "node long, linked long, root long"),
        "links",
    )
    linked = found.groupBy(F.col("node").alias("_node")).agg(F.sum("linked").alias("_linked"))
    reached = land(components(found, "node", "root").join(
        classes.select("node", "rep"), F.col("member") == F.col("node")
    ).select("member", "root", "rep"), "members")
    least_of = reached.groupBy(F.col("root").alias("_r")).agg(F.min("rep").alias("_root"))
    roots = lookup_join(reached.drop("rep"), land(least_of, "roots"), [("root", "_r")]).select("member", "_root")
    per_class = (
        classes.select("_class", "node", "rep", "weight")
        .join(linked, F.col("node") == F.col("_node"), "left")
        .join(roots, F.col("node") == F.col("member"), "left")
        .select(
            "_class", (F.col("weight") - 1 + F.coalesce("_linked", F.lit(0))).alias("_n"),
            F.coalesce("_root", "rep").alias("_root"),
        )
    )
    joined = lookup_join(own, land(per_class, "per-class"), [("_key", "_class")], "left")
    root = F.coalesce("_root", q(vec_id))
    return joined.select(
        *keep,
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        root.cast("long").alias("component_id"),
        F.coalesce(root == q(vec_id), F.lit(False)).alias("kept"),
    )


def _blocks_and_units(hashed: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """``node, block`` of each node; ``unit, node, block, role, bits`` of each place where it is compared.

    A bucket of at most ``BLOCK`` rows is one unit. A larger one is cut into parts, and each part of its home
    rows meets each part of all its rows.
    """
    place = F.posexplode("codes").alias("_place", "_code")
    bucket = F.xxhash64("part", F.floor(F.col("_place") / width), "_code")
    home = F.col("_place") % width == 0
    crowded = land(
        hashed.select("part", place)
        .groupBy(bucket.alias("_crowded"))
        .agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_cuts"),
            F.ceil(F.count(F.when(home, 1)) / BLOCK).cast("int").alias("_home_cuts"),
        )
        .where("_cuts > 1"),
        "crowded",
    )
    cuts = F.coalesce("_cuts", F.lit(1))
    first = hashed.select("node", F.xxhash64("part", F.lit(0).cast("long"), F.col("codes")[0]).alias("_first"))
    home_cuts = F.greatest(F.coalesce("_home_cuts", F.lit(1)), F.lit(1))
    blocks = land(
        lookup_join(first, crowded, [("_first", "_crowded")], "left").select(
            "node", F.xxhash64("_first", F.pmod(F.xxhash64("node"), home_cuts)).alias("block")
        ), "blocks",
    )
    with_block = lookup_join(hashed, blocks.withColumnRenamed("node", "_of"), [("node", "_of")]).drop("_of")
    met = lookup_join(
        with_block.select("node", "block", "bits", "part", place).withColumn("_bucket", bucket), crowded,
        [("_bucket", "_crowded")], "left",
    )
    mine = F.pmod(F.xxhash64("node"), cuts).cast("int")
    every = F.sequence(F.lit(0), cuts - 1)

    def cell(i, j, role):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).cast("byte").alias("role"))

    cells = (
        F.when(home & (cuts == 1), F.array(cell(mine, mine, BOTH)))
        .when(home, F.concat(
            F.transform(every, lambda x: cell(mine, x, HOME)), F.transform(every, lambda x: cell(x, mine, PROBE_ONLY))
        ))
        .otherwise(F.transform(every, lambda x: cell(x, mine, PROBE_ONLY)))
    )
    units = met.select("node", "block", "bits", "_bucket", F.explode(cells).alias("_cell")).select(
        F.xxhash64("_bucket", "_cell.i", "_cell.j").alias("unit"), "node", "block", "_cell.role", "bits"
    )
    return blocks, units


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return near_duplicates(rows).drop("embedding", "label")
