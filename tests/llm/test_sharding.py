"""Shards against a plain sort of all rows."""

import hashlib
import random
import zlib

import pytest

from salesloom.llm import registry
from salesloom.llm.sharding import interleave, op11_sharding, write_shards

SCHEMA = "doc_id long, source string"


def plain(rows, shards, seed=11):
    """(doc_id, source) pairs to {doc_id: (shard, slot)}."""
    by_source = {}
    for i, s in rows:
        by_source.setdefault("1" if s is None else "0" + s, []).append(i)
    order = []
    for s, ids in by_source.items():
        ids.sort(key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:16])
        order += [((2 * r + 1) / (2 * len(ids)), s.encode(), i) for r, i in enumerate(ids)]
    n, out, used = len(order), {}, [0] * shards
    for place, (_, _, i) in enumerate(sorted(order)):
        k = place * shards // n
        out[i] = (k, used[k])
        used[k] += 1
    return out


def made(n, seed=1):
    rng = random.Random(seed)
    names = ["a"] * 6 + ["b"] * 3 + ["Ä", "", "zz", None]
    return [(i, rng.choice(names)) for i in range(n)]


@pytest.mark.parametrize("n, shards", [(1, 4), (3, 16), (500, 7), (997, 16)])
def test_equals_plain_sort(spark, n, shards):
    rows = made(n)
    got = interleave(spark.createDataFrame(rows, SCHEMA).repartition(5), shards).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == plain(rows, shards)


def test_every_shard_has_the_mixture(spark):
    rows = made(2000, 4)
    got = interleave(spark.createDataFrame(rows, SCHEMA), 16).collect()
    sources = {s for _, s in rows}
    for s in sources:
        n = sum(x == s for _, x in rows)
        for k in range(16):
            here = sum(r.shard == k and r.source == s for r in got)
            assert abs(here - n / 16) <= 1 + len(sources) * n / len(rows)
    sizes = [sum(r.shard == k for r in got) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_partitions_do_not_matter(spark):
    frame = spark.createDataFrame(made(300), SCHEMA)
    few, many = (sorted(interleave(frame.repartition(n)).collect()) for n in (1, 9))
    assert few == many


def test_edges(spark):
    rows = [(None, None, "x", 1), (None, "a", "x", 2), (7, "a", None, 3), (7, "a", None, 3), (7, "a", "other", 4)]
    schema = "doc_id long, source string, _row string, slot int"
    got = interleave(spark.createDataFrame(rows, schema), 2).collect()
    assert got[0].asDict().keys() == {"doc_id", "source", "_row", "shard", "slot"}
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert interleave(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        interleave(spark.createDataFrame(rows, schema), 0)


@pytest.mark.parametrize("name", ["_source", "_at", "_kept", "_row"])
def test_clashing_names(spark, name):
    rows = [(i, "ab"[i % 2], i) for i in range(20)]
    got = interleave(spark.createDataFrame(rows, f"doc_id long, source string, {name} int"), 4).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == plain([r[:2] for r in rows], 4)
    assert all(r[name] == r.doc_id for r in got)


def test_a_hot_source_and_repeated_rows_are_many_ranges(spark):
    rows = [(1, "hot")] * 3000 + [(i, "s") for i in range(2, 1002)]
    got = interleave(spark.createDataFrame(rows, SCHEMA), 16)
    assert got.groupBy("shard").count().count() == 16
    sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert sizes == [250] * 16
    assert sorted(r.n for r in got.where("doc_id = 1").groupBy("shard").agg({"*": "count"}).toDF("shard", "n").collect())[0] >= 186


def test_write_shards(spark, tmp_path):
    rows = [(i, s, f"text {i}") for i, s in made(200)]
    docs = spark.createDataFrame(rows, SCHEMA + ", text string")
    write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in back} == plain([r[:2] for r in rows], 4)
    assert {(r.doc_id, r.source, r.text) for r in back} == set(rows)
    with pytest.raises(ValueError):
        write_shards(docs.union(docs), str(tmp_path / "twice"))


def test_query(spark, tmp_path):
    texts = [None, "", "aä\U0001F600", "same", "same", "x" * 100_000]
    rows = [(i, t, "s" if i % 2 else None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op11_sharding(spark, str(tmp_path)).collect()}
    placed = plain([(i, s) for i, _, s in rows], 16)
    for i, t, _ in rows:
        data = (t or "").encode()
        assert (got[i].size, got[i].text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert (got[i].shard, got[i].slot) == placed[i]
        assert got[i].law == "rows" and got[i].grown_shard is None


def test_main_path_has_no_python(spark, tmp_path):
    spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = registry.queries()["op11_sharding"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
