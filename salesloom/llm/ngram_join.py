"""N-gram Jaccard join as a blocked product of the document by n-gram incidence matrix.

A full product costs the square of each frequent n-gram's documents, so it is formed in two steps.

1. Columns (n-grams) are cut into blocks by hash. Two documents that may link differ in at most
   ``(100 - T) / (100 + T)`` of their summed sizes, and a size class has more blocks than
   that; so they must have equal rows in several blocks. Equal block rows are joined, agreeing blocks
   are added up per pair, and pairs below the bound that their sizes set are discarded.
2. What is left falls into small clusters. There the product is exact: overlaps are added
   up column block by column block, and a pair is discarded when its sizes rule it out.

Documents with equal sets are one row of the matrix; classes, counts and clusters stay distributed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, ascii_lower, own_memory, small_batches, table, words
from salesloom.llm.components import components
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

SHINGLE = 3
#: Documents link from this many hundredths of Jaccard similarity.
PERCENT = 90
# Growth of the size classes, and chance that two linked documents meet in no block.
CLASS_GROWTH = 1.5
MISSES = 1e-9
# Block rows shared by more documents than this are compared in units of BLOCK x BLOCK documents.
SMALL_GROUP = 32
BLOCK = 256
# N-grams that a block of documents may hold, and columns that are multiplied at once.
BLOCK_NGRAMS = 1_000_000
COLUMNS = 4096
LEFT, RIGHT, BOTH = 0, 1, 2
_SIGN = np.uint64(1 << 63)


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Sorted hashes of the distinct word n-grams; of all words as one where there are fewer."""

    def windows(h: Column) -> Column:
        rest = F.slice(h, size, F.greatest(F.size(h) - (size - 1), F.lit(0)))
        return F.transform(
            rest, lambda last, i: F.xxhash64(*[F.get(h, i + k) for k in range(size - 1)], last)
        )

    def of(h: Column) -> Column:
        whole = F.array(F.xxhash64(F.size(h), h))
        return F.when(F.size(h) >= size, windows(h)).when(F.size(h) > 0, whole).otherwise(
            F.array().cast("array<long>")
        )

    hashed = F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.get(F.transform(F.array(hashed), of), F.lit(0))))


def most_different(total: int, percent: int = PERCENT) -> int:
    """N-grams in which two linked documents of ``total`` n-grams together may differ."""
    return total * (100 - percent) // (100 + percent)


def size_classes(percent: int = PERCENT, largest: int = 1 << 31) -> tuple[np.ndarray, np.ndarray]:
    """Least sizes of the classes, and numbers of column blocks; 0 where only equal sets link."""
    lows = [1]
    while lows[-1] <= largest:
        lows.append(max(lows[-1] + 1, int(lows[-1] * CLASS_GROWTH)))
    blocks = []
    for low, high in zip(lows, lows[1:]):
        d = most_different(2 * (high - 1), percent)
        if d == 0:
            blocks.append(0)
            continue
        k, n = d + 4, math.ceil(low * percent / 100)

        def risky(k: int) -> bool:
            """Whether all n-grams of a document fall into d of the blocks too often."""
            ways = math.lgamma(k + 1) - math.lgamma(d + 1) - math.lgamma(k - d + 1)
            return ways + n * math.log(d / k) > math.log(MISSES)

        # The least number that is not: in growing steps, then in between.
        low_k, step = k - 1, 1
        while risky(k):
            low_k, k, step = k, k + step, 2 * step
        while k - low_k > 1:
            middle = (low_k + k) // 2
            low_k, k = (middle, k) if risky(middle) else (low_k, middle)
        blocks.append(k)
    return np.array(lows), np.array(blocks)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_rows(flat: np.ndarray, sizes: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each document's row in each of its column blocks, 0 where it has no n-gram.

    ``flat``: sorted sets one after the other; ``sizes``, ``blocks``: per document. Gives the hashes
    one document after the other, and where each one begins.
    """
    begins = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(begins[-1], np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if len(owner):
        x = flat.view(np.uint64) ^ _SIGN
        k = blocks[owner]
        place = np.minimum(((x >> np.uint64(11)).astype(np.float64) * (2.0**-53 * k)).astype(np.int64), k - 1)
        cell = begins[owner] + place
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sums = np.add.reduceat(_mix(x), first)
        cell, own = cell[first], owner[first]
        tag = (cell - begins[own]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        tag ^= blocks[own].astype(np.uint64) << np.uint64(40)
        found = _mix(sums + _mix(tag))
        out[cell] = np.where(found == 0, np.uint64(1), found)
    return out.view(np.int64), begins


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and where each list begins."""
    column = batch[name]
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return (
        column.flatten().to_numpy(zero_copy_only=False),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
    )


def _list_array(values: np.ndarray, begins: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values))


def _sketch(percent: int) -> Callable:
    """From sets to size, a 128-bit key of the set, and block rows in the size's one or two classes."""
    lows, counts = size_classes(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = _lists(batch, "grams")
            sizes = np.diff(begins)
            flat = np.ascontiguousarray(flat, np.int64)
            mixed = _mix(flat.view(np.uint64))
            keys = []
            for salt in (0, 0x5851F42D4C957F2D):
                sums = np.zeros(len(mixed) + 1, np.uint64)
                np.cumsum(_mix(mixed + np.uint64(salt)), out=sums[1:])
                keys.append((sums[begins[1:]] - sums[begins[:-1]]).astype(np.uint64).view(np.int64))
            own = np.searchsorted(lows, sizes, side="right") - 1
            arrays = [batch["doc_id"], pa.array(sizes), pa.array(keys[0]), pa.array(keys[1])]
            above = np.where(sizes * 100 >= lows[own + 1] * percent, own + 1, -1)
            for scheme in (own, above):
                k = np.where((scheme >= 0) & (sizes > 0), counts[scheme], 0)
                used = k > 0
                pick = np.repeat(used, sizes)
                rows, starts = block_rows(flat[pick], sizes[used], k[used])
                ends = np.zeros(len(sizes) + 1, np.int64)
                ends[1:] = np.cumsum(k)
                arrays.append(_list_array(rows, ends))
            yield pa.record_batch(
                arrays, names=["doc_id", "n", "key1", "key2", "rows1", "rows2"]
            )

    return run


def _units(batches: Iterator[pa.RecordBatch], lists: str, compare: Callable) -> Iterator[pa.RecordBatch]:
    """Runs ``compare`` on the rows of each unit; rows come sorted by unit."""
    names = ["rep", "role", "n"]
    unit, held, out = None, [], []
    for batch in batches:
        flat, begins = _lists(batch, lists)
        columns = [batch[c].to_pylist() for c in names]
        for i, (u, *row) in enumerate(zip(batch["unit"].to_pylist(), *columns)):
            if u != unit:
                compare(held, out)
                unit, held = u, []
            held.append((*row, flat[begins[i] : begins[i + 1]]))
        if out:
            yield _edges(out)
            out = []
    compare(held, out)
    if out:
        yield _edges(out)


def _edges(out: list) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*out))
    return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})


def _sides(rows: list) -> tuple[list, list]:
    """Documents to compare. Which are on both sides come first on both, in the same order."""
    rows = sorted(rows, key=lambda r: (r[1] != BOTH, r[0]))
    return [r for r in rows if r[1] != RIGHT], [r for r in rows if r[1] != LEFT]


def _forest(left: list, right: list, linked: np.ndarray, out: list) -> None:
    """Adds each document and the least one that it reaches by the unit's links."""
    i, j = np.nonzero(linked)
    ids = np.array([r[0] for r in left] + [r[0] for r in right], np.int64)
    root, j = ids.copy(), j + len(left)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (before == root).all():
            break
    hung = root != ids
    if hung.any():
        out.append((ids[hung], root[hung]))


def _agreeing(percent: int) -> Callable:
    """Edges between documents of a crowded block row that agree in enough other blocks."""

    def compare(rows: list, out: list) -> None:
        left, right = _sides(rows)
        if not left or not right:
            return
        k = len(left[0][3])
        right = [r for r in right if len(r[3]) == k]
        a, b = (np.stack([r[3] for r in side]) for side in (left, right))
        total = np.array([r[2] for r in left])[:, None] + np.array([r[2] for r in right])[None, :]
        missing = np.zeros(total.shape, np.int32)
        allowed = total * (100 - percent) // (100 + percent)
        for c in range(k):  # an empty block of both agrees as well
            missing += a[:, c][:, None] != b[:, c][None, :]
        _forest(left, right, missing <= allowed, out)

    return lambda batches: _units(batches, "rows", compare)


def _overlapping(percent: int) -> Callable:
    """Edges between linked documents: the exact product of a unit's rows."""

    def compare(rows: list, out: list) -> None:
        left, right = _sides(rows)
        if not left or not right or len(rows) == 1:
            return
        same = left is right or [r[0] for r in left] == [r[0] for r in right]
        docs = left if same else left + right
        columns, place = np.unique(np.concatenate([r[3] for r in docs]), return_inverse=True)
        owner = np.repeat(np.arange(len(docs)), [len(r[3]) for r in docs])
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        n = np.array([r[2] for r in docs])
        n_left, n_right = n[: len(left)], n if same else n[len(left) :]
        need = -(-percent * (n_left[:, None] + n_right[None, :]) // (100 + percent))
        need[need > np.minimum(n_left[:, None], n_right[None, :])] = 1 << 60  # sizes too different
        overlap = np.zeros(need.shape, np.int64)
        seen = np.zeros(len(docs), np.int64)
        for start in range(0, len(columns), COLUMNS):
            lo, hi = np.searchsorted(place, [start, start + COLUMNS])
            part = np.zeros((len(docs), min(COLUMNS, len(columns) - start)), np.float32)
            part[owner[lo:hi], place[lo:hi] - start] = 1
            other = part if same else part[len(left) :]
            overlap += (part[: len(left)] @ other.T).astype(np.int64)
            seen += part.sum(axis=1).astype(np.int64)
            rest = n - seen
            most = np.minimum(rest[: len(left)][:, None], (rest if same else rest[len(left) :])[None, :])
            if not (overlap + most >= need).any():
                return  # no pair of the unit can reach its bound any more
        _forest(left, right, overlap >= need, out)

    return lambda batches: _units(batches, "grams", compare)


def _by_unit(df: DataFrame) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "unit").sortWithinPartitions("unit")


def _cell(i: Column, j: Column, role: int) -> Column:
    return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).alias("role"))


def _squares(mine: Column, blocks: Column) -> Column:
    """Units of a group that is split into ``blocks``: each block meets itself and each other once."""
    every = F.sequence(F.lit(0), blocks - 1)
    # Of two blocks the lower one is on the left.
    return F.transform(
        every,
        lambda x: F.when(x == mine, _cell(mine, mine, BOTH))
        .when(x > mine, _cell(mine, x, LEFT))
        .otherwise(_cell(x, mine, RIGHT)),
    )


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect all documents that may link."""
    rows = classes.select(
        "rep", "n", F.explode(F.array("rows1", "rows2")).alias("rows")
    ).where("size(rows) > 0")
    # Blocks without n-grams agree, too, but are not joined: at most the fewer of two documents' empty ones.
    # Counted once a list, before it is exploded: Spark would count beside the explode once for each of its cells.
    empty = (F.size("rows") - F.size(F.array_remove("rows", F.lit(0)))).alias("e")
    cells = rows.select("rep", "n", F.size("rows").alias("k"), empty, "rows").select(
        "rep", "n", "k", "e", F.explode("rows").alias("row")
    ).where("row <> 0")
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("k").cast("long"))
    shared = land(
        cells.groupBy("row").agg(
            F.count(F.lit(1)).alias("c"), F.min("rep").alias("a"), F.max("rep").alias("b"),
            F.sum(packed).alias("packed"), F.min("e").alias("e"),
        ).where("c > 1"),
        "shared",
    )
    two = shared.where("c = 2").select(
        "a", "b", F.shiftright("packed", 32).alias("total"),
        (F.col("packed").bitwiseAND(F.lit(0xFFFFFFFF)) / 2).cast("int").alias("k"), "e",
    )
    some = shared.where(f"c > 2 AND c <= {SMALL_GROUP}").select(F.col("row").alias("_row"))
    lists = (
        lookup_join(cells, some, [("row", "_row")])
        .groupBy("row", "k")
        .agg(F.array_sort(F.collect_list(F.struct("rep", "n", "e"))).alias("docs"))
    )
    few = lists.select("k", "docs", F.posexplode("docs").alias("i", "x")).select(
        "k", "x", F.explode(F.slice("docs", F.col("i") + 2, SMALL_GROUP)).alias("y")
    ).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), (F.col("x.n") + F.col("y.n")).alias("total"), "k",
        F.least("x.e", "y.e").alias("e"),
    )
    allowed = F.floor(F.col("total") * (100 - percent) / (100 + percent))
    # A pair that meets in a crowded block row, too, is judged there by all of its blocks.
    counted = (
        two.select("a", "b", "total", "k", "e").union(few.select("a", "b", "total", "k", "e"))
        .groupBy("a", "b", "k")
        .agg(F.count(F.lit(1)).alias("agree"), F.max("total").alias("total"), F.max("e").alias("e"))
    )
    pairs = counted.where(F.col("agree") + F.col("e") >= F.col("k") - allowed)
    crowd = shared.where(f"c > {SMALL_GROUP}").select(
        F.col("row").alias("_row"), F.ceil(F.col("c") / BLOCK).cast("int").alias("_blocks")
    )
    crowded = lookup_join(
        rows.select("rep", "n", "rows", F.explode("rows").alias("row")).where("row <> 0"), crowd, [("row", "_row")]
    )
    mine = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    units = crowded.select(
        "rep", "n", "rows", "row", F.explode(_squares(mine, F.col("_blocks"))).alias("_cell")
    ).select(
        "rep", "n", "rows", "_cell.role", F.xxhash64("row", "_cell.i", "_cell.j").alias("unit")
    )
    close = _by_unit(units).mapInArrow(own_memory(_agreeing(percent)), "a long, b long")
    return pairs.select("a", "b").union(close)


def _verified(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the units of ``members`` (``rep``, ``role``, ``unit``), as edges."""
    joined = lookup_join(
        members.select(F.col("rep").alias("_rep"), "role", "unit"), sets, [("_rep", "rep")]
    )
    rows = joined.select("rep", "role", "unit", F.size("grams").alias("n"), "grams")
    return _by_unit(rows).mapInArrow(own_memory(_overlapping(percent)), "a long, b long")


@any_names
def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    Two documents link when 100 times the overlap of their n-gram sets is at least ``percent`` times
    the union. ``component_id`` is the least id reachable by links. Words are what is between white
    space, A-Z lower-cased; a text with fewer words than ``size`` is one n-gram; without
    words or with a NULL text the set is empty and links with nothing. Rows with the same id count as
    one document; a NULL id links with nothing and has no component. An empty table gives an empty
    one; other columns are not read.

    Pairs are compared only inside groups that share a block row or a cluster, in units of at most
    ``BLOCK`` documents a side; no task holds a larger group, and units send on one edge per document.
    """
    small_batches(docs.sparkSession)
    identified = docs.select(q(doc_id).cast("long").alias("doc_id"), shingles(q(text), size).alias("grams"))
    fields = [StructField(c, LongType()) for c in ("doc_id", "n", "key1", "key2")]
    rows = [StructField(c, ArrayType(LongType())) for c in ("rows1", "rows2")]
    sketch = own_memory(_sketch(percent))
    sketched = land(identified.mapInArrow(sketch, StructType(fields + rows)), "sketches")
    classes = land(
        sketched.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("key1", "key2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("rows1").alias("rows1"), F.first("rows2").alias("rows2")),
        "classes",
    )
    clusters = components(_candidates(classes, percent))
    members = clusters.join(classes.select("rep", "n"), F.col("member") == F.col("rep"))
    mass = members.groupBy(F.col("root").alias("_root")).agg(
        F.count(F.lit(1)).alias("_docs"), F.sum("n").alias("_ngrams")
    ).select(
        "_root",
        F.greatest(F.ceil(F.col("_docs") / BLOCK), F.ceil(F.col("_ngrams") / BLOCK_NGRAMS)).cast("int").alias("_blocks"),
    )
    members = land(
        lookup_join(members.select("rep", "root"), mass, [("root", "_root")]).drop("_root"), "members"
    )
    texts = lookup_join(
        docs.select(q(doc_id).cast("long").alias("_id"), q(text).alias("_text")),
        members.select("rep").distinct(), [("_id", "rep")],
    )
    # Not filtered before it is landed: Spark would do that below the join and form the n-grams of every document.
    sets = land(texts.select("rep", shingles(F.col("_text"), size).alias("grams")), "sets").where("size(grams) > 0")
    # First all of a small cluster, and the first block of a large one with all its documents.
    mine = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    zero = F.lit(0)
    spokes = F.when(
        mine == 0,
        F.transform(every, lambda x: F.when(x == 0, _cell(zero, zero, BOTH)).otherwise(_cell(zero, x, LEFT))),
    ).otherwise(F.array(_cell(zero, mine, RIGHT)))
    units = members.select("rep", "root", F.explode(spokes).alias("_cell")).select(
        "rep", "_cell.role", F.xxhash64("root", "_cell.i", "_cell.j").alias("unit")
    )
    links = land(_verified(units, sets, percent), "edges")
    found = components(links)
    if members.where("_blocks > 1").limit(1).count():
        links = links.union(_stragglers(members, found, sets, percent))
        found = components(links)
    # From documents to classes to components.
    roots = classes.select("key1", "key2", "n", "rep").join(found, F.col("rep") == F.col("member"), "left").select(
        F.concat_ws(" ", "key1", "key2", "n").alias("_class"), F.coalesce("root", "rep").alias("_root")
    )
    own = sketched.select(
        "doc_id", "n",
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.concat_ws(" ", "key1", "key2", "n")).alias("_key"),
    )
    return lookup_join(own, land(roots, "roots"), [("_key", "_class")], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_root", "doc_id").alias("component_id")
    )


@any_names
def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: the least id.

    Documents without n-grams stay, and so do rows with a NULL id. Of repeated rows with one id one
    stays. Columns stay as they are.
    """
    found = land(jaccard_components(docs, doc_id, text, size, percent), "components")
    first = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_first")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    first = land(first, "first")
    kept = lookup_join(docs.withColumn("_id", q(doc_id).cast("long")), first.drop("_rows"), [("_id", "_first")])
    if first.where("_rows > 1").limit(1).count():
        kept = kept.dropDuplicates(["_id"])
    return kept.drop("_id", "_first").union(docs.where(q(doc_id).isNull()))


def _stragglers(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of what the first round left apart in large clusters: those documents with all others."""
    large = members.where("_blocks > 1").join(found.withColumnRenamed("root", "_part"), F.col("rep") == F.col("member"), "left")
    large = land(large.select("rep", F.col("root"), "_blocks", F.coalesce("_part", "rep").alias("_part")), "large")
    sizes = large.groupBy("root", "_part").count()
    biggest = sizes.groupBy(F.col("root").alias("_root")).agg(F.max_by("_part", F.struct("count", "_part")).alias("_main"))
    split = lookup_join(large, biggest, [("root", "_root")])
    mine = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    # A document apart is on the left of every unit of its row; all are on the right in every row.
    apart = F.col("_part") != F.col("_main")
    rows = land(split.where(apart).select("root", mine.alias("i")).distinct(), "rows")
    left = split.where(apart).select("rep", "root", F.explode(F.transform(every, lambda x: _cell(mine, x, LEFT))).alias("_cell"))
    per_root = rows.groupBy(F.col("root").alias("_r")).agg(F.collect_set("i").alias("_rows"))
    right = lookup_join(split.select("rep", "root", mine.alias("_mine")), per_root, [("root", "_r")]).select(
        "rep", "root", F.explode(F.transform("_rows", lambda x: _cell(x, F.col("_mine"), RIGHT))).alias("_cell")
    )
    units = left.union(right).select(
        "rep", "_cell.role", F.xxhash64("root", "_cell.i", "_cell.j").alias("unit")
    )
    return land(_verified(units, sets, percent), "edges")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
