"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import lookup_join
from salesloom.scratch import land


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``member`` and ``root``, the least id reachable; one row for each id in a link.

    Two steps alternate until nothing changes. Large star: each node hangs its larger neighbours
    on the least id it sees. Small star: each node hangs its smaller neighbours and itself there.
    The rounds grow with the logarithm of the longest chain. Each round is landed, so a lost
    executor repeats one round at most. Minima are formed in each task before the shuffle and landed;
    the links then look them up, so a node with very many links is broadcast or salted
    (:func:`salesloom.operators.joins.lookup_join`) and never one task.

    Links to itself and NULL ends are ignored; no links give an empty frame.
    """
    edges = land(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("member"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = state
        edges = land(_small_star(land(_large_star(edges), "links")), "links")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = land(both.groupBy(F.col("u").alias("n")).agg(F.min(F.least("u", "v")).alias("m")), "least")
    larger = both.where("v > u")  # the smaller neighbours of u are kept by their own turn
    moved = lookup_join(larger, least, [("u", "n")]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = land(edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "least")
    joined = lookup_join(edges, least, [("u", "n")])
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
