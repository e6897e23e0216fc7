import math

import numpy as np
import pytest

from salesloom.llm import embed_dedup
from salesloom.llm.embed_dedup import codes, index_shape, near_duplicates
from tests.llm.brute import roots

SCHEMA = "vec_id long, embedding array<float>, label int, Kept string"


def vectors(n, seed, dimension=32, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dimension))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            v = rng.normal(size=dimension)
        else:
            v = middle[rng.integers(centres)]
            if kind < 0.9:
                v = v + rng.normal(size=dimension) * rng.choice([0.02, 0.1, 0.14, 0.18])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(rng.integers(3)), "x"))
    return rows


def brute(rows):
    ok = [r for r in rows if r[1] and r[2] is not None and None not in r[1]
          and np.isfinite(r[1]).all() and np.any(r[1])]
    unit = [np.array(r[1], np.float64) / np.linalg.norm(np.array(r[1], np.float64)) for r in ok]
    links = [
        (ok[i][0], ok[j][0]) for i in range(len(ok)) for j in range(i)
        if ok[i][2] == ok[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
    ]
    root = roots([r[0] for r in rows], links)
    return {r[0]: (sum(r[0] in p for p in links), root[r[0]]) for r in rows}


def check(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (*want[r.vec_id], r.vec_id == want[r.vec_id][1])


@pytest.mark.parametrize("seed", range(2))
def test_as_brute_force(spark, seed):
    check(spark, vectors(500, seed))


def test_crowded_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 10)
    check(spark, vectors(260, 5, centres=2))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 2.0]
    rows = [(0, None, 1, "a"), (1, [], 1, "a"), (2, [0.0, 0.0], 1, "a"), (3, [nan, 1.0], 1, "a"), (4, [inf, 1.0], 1, "a"),
            (5, [None, 1.0], 1, "a"), (6, one, None, "a"), (7, one, None, "a"), (8, one, 1, "a"), (9, one, 1, "a"),
            (10, [2.0, 0.0, 4.0], 1, "a"), (11, one, 2, "a"), (12, [1.0], 1, "a"), (13, [5.0], 1, "a"), (14, [-5.0], 1, "a"),
            (15, [1e30, 1e30], 1, "a"), (16, [1e-30, 1e-30], 1, "a"), (17, [1.0, 1.0], 1, "a")]
    check(spark, rows)
    more = near_duplicates(spark.createDataFrame([(None, one, 1, "a"), (None, one, 1, "a"), (3, one, 1, "a"), (3, one, 1, "a")], SCHEMA))
    assert more.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in more.collect()) == [
        ("3", 1, True), ("3", 1, True), ("None", 0, False), ("None", 0, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("hashes", [1, 2, 3])
def test_recall_of_the_index(hashes):
    """Pairs just at the least cosine meet as often as the index shape counts on."""
    rng = np.random.default_rng(1)
    n, d = 3000, 64
    a = rng.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(n, d))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    x, y = codes(a, hashes, 4), codes(b, hashes, 4)
    meet = (x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)
    counted = embed_dedup.AGREE**hashes + hashes * embed_dedup.AGREE ** (hashes - 1) * (
        embed_dedup.NEARLY - embed_dedup.AGREE)
    assert meet.mean() > counted - 0.02
    size = [index_shape(v, d) for v in (10, 10**4, 10**6, 10**9)]
    assert size == sorted(size) and size[0][0] == 1


def test_ids_that_occur_with_several_vectors(spark):
    """Rows stay as many as they are; an id stands for each of its rows."""
    rows = [(3, [1.0, 0.0], 1, "a"), (3, [0.0, 1.0], 1, "a"), (3, [1.0, 0.0], 2, "a"), (5, [2.0, 0.0], 1, "a"),
            (1, [0.0, 3.0], 1, "a")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.embedding, r.label, r.n_links, r.component_id) for r in got) == [
        (1, [0.0, 3.0], 1, 1, 1), (3, [0.0, 1.0], 1, 1, 1), (3, [1.0, 0.0], 1, 1, 3), (3, [1.0, 0.0], 2, 0, 3),
        (5, [2.0, 0.0], 1, 1, 3)]


@pytest.mark.parametrize("dimension", [2, 16, 64])
def test_sketches_keep_links_and_part_strangers(dimension):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 20000, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    most = embed_dedup.most_bits(0.98)

    def differ(x, y):
        return np.unpackbits(embed_dedup.sketch(x) ^ embed_dedup.sketch(y), axis=1).sum(axis=1)

    assert differ(a, c).max() <= most
    if dimension == 64:
        assert (differ(a, a[::-1]) > most).mean() > 0.999


def test_planted_links_are_found(spark):
    """All of 1,500 pairs just above the least cosine, among vectors that link with nothing."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(1500, 64))
    b = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.9802 * a + math.sqrt(1 - 0.9802**2) * b
    rows = [(i, [float(x) for x in v], 1, "x") for i, v in enumerate(np.concatenate([a, c, rng.normal(size=(2000, 64))]))]
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].component_id for i in range(1500, 3000)] == list(range(1500))
    assert all(got[i].n_links == (i < 3000) for i in got)
