"""Shards that all have the mixture of the sources, by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked. A row's rank as a fraction of its
source says where in the whole it belongs: sorted by that fraction the sources interleave in
proportion, and any run of rows has their mixture. The run is cut into shards of equal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from salesloom.functions.columns import q
from salesloom.llm.common import others, table
from salesloom.operators.joins import lookup_join, require_unique
from salesloom.operators.ordinal import with_ordinal
from salesloom.scratch import land

SEED = 11
SHARDS = 16


def _shuffled(doc_id: Column, seed: int) -> Column:
    """Sort key of a row within its source: 64 bits of a digest, as text."""
    id_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256), 1, 16)


def _source_key(source: Column) -> Column:
    """Sources by code point, NULL last: a source of its own."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def interleave(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", source: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (from 0) and ``slot`` (from 0 in each shard, no gaps).

    Row counts of shards are at most one apart. A source with ``n`` of all ``N`` rows and ``G`` sources has in
    each shard its share of the rows to within ``1 + G * n / N``. Rows of a shard are in
    mixed order: read by ``slot``, each prefix has the mixture too.

    Ids decide, so the same rows and seed give the same shards however they are partitioned. Rows
    with the same id keep one order by their content. A NULL source is a source of its own, a NULL id is
    shuffled as the empty text; fewer rows than shards leave shards empty, and an empty table gives
    an empty one. Columns named like the two new ones are replaced.

    Both sorts are range-partitioned and numbered without a window over a source: a source with a third of all
    rows is many ranges, and so is a row that is repeated very often. Rows move twice with all
    their columns: give ids, and let :func:`write_shards` move the texts once.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    made = ["shard", "slot"]
    keep = others(docs, made)
    plain = [q(f.name) for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    rows = docs.select(
        F.struct(*keep, F.lit(0).alias("_pad")).alias("_kept"), _source_key(q(source)).alias("_source"),
        _shuffled(q(doc_id), seed).alias("_order"), F.xxhash64(*plain).alias("_same"),
    )
    ranked = with_ordinal(rows, ["_source", "_order"], name="_at")
    sources = land(
        ranked.groupBy(F.col("_source").alias("_of")).agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
        ),
        "sources",
    )
    placed = lookup_join(ranked, sources, [("_source", "_of")])
    fraction = (2 * (F.col("_at") - F.col("_first")) + 1) / (2 * F.col("_rows")).cast("double")
    mixed = with_ordinal(
        placed.select("_kept", "_source", "_same", fraction.alias("_fraction")),
        ["_fraction", "_source"], name="_place",
    )
    total = sources.agg(F.sum("_rows").alias("_total")).scalar()
    cut = mixed.withColumn("_total", total).withColumn(
        "_shard", F.expr(f"(_place * {int(shards)}) div _total")
    )
    first = F.expr(f"(_shard * _total + {int(shards) - 1}) div {int(shards)}")
    return cut.select(
        "_kept.*", F.col("_shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot")
    ).drop("_pad")


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, doc_id: str = "doc_id", source: str = "source",
    seed: int = SEED,
) -> None:
    """Write ``docs`` below ``path`` as Parquet, a folder ``shard=k`` each, files in ``slot`` order.

    Ids must be present and unique. Texts move once: the shards are found from ids and sources,
    joined to the rows, and each shard is written by as many tasks as ranges of slots fall on it.
    """
    if docs.where(q(doc_id).isNull()).limit(1).count():
        raise ValueError(f"{doc_id} is NULL")
    require_unique(docs, doc_id)
    found = interleave(docs.select(q(doc_id), q(source)), shards, doc_id, source, seed)
    places = found.select(q(doc_id).alias("_of_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    keep = others(docs, ["shard", "slot"])
    rows = docs.select(F.struct(*keep, F.lit(0).alias("_pad")).alias("_kept"), q(doc_id).alias("_id"))
    joined = lookup_join(rows, places, [("_id", "_of_id")]).drop("_id", "_of_id")
    ordered = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    columns = ordered.select("_kept.*", F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
    columns.drop("_pad").write.partitionBy("shard").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: row counts of shards are at most one apart."""
    docs = table(spark, sf_dir, "documents")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(
        "doc_id", "source", (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    return interleave(land(slim, "sizes")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


#: CRC-32 is folded over the bytes with a table made by the usual rule.
CRC_SQL = r"""
crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)::UBIGINT[]), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)::UBIGINT[]) AS n)
)"""

OP11_SQL = "WITH " + CRC_SQL.strip() + r""",
bytes AS (
  SELECT doc_id, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda x: ('0x' || x)::UBIGINT) AS b FROM documents
), rows AS (
  SELECT doc_id, source, len(b) + 1 AS size,
    xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, b), lambda c, x:
      xor(c // 256, t[(xor(c % 256, x) + 1)::BIGINT]))) AS crc
  FROM bytes, crc_table
), ranked AS (
  SELECT *, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s,
    row_number() OVER (PARTITION BY source ORDER BY substr(sha256('11:' || coalesce(doc_id::VARCHAR, '')), 1, 16)) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1) / (2 * n)::DOUBLE, s) - 1 AS place FROM ranked
), cut AS (SELECT *, place * 16 // total AS k FROM placed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, k::INTEGER AS shard,
  (place - (k * total + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM cut
"""
