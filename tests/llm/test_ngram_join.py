import random

import numpy as np
import pytest

from salesloom.llm import ngram_join
from salesloom.llm.components import components
from salesloom.llm.ngram_join import drop_near_copies, jaccard_components, most_different, size_classes
from tests.llm.brute import jaccard_components as brute, roots

SCHEMA = "doc_id long, text string, component_id string"


def corpus(n, seed, groups=6):
    """Texts of their own, groups of near copies by a few edits, exact copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    bases = [rng.choices(vocabulary, k=rng.choice([12, 25, 60, 150, 400])) for _ in range(groups)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 120)))
        elif kind < 0.45:
            text = passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 15)))
        else:
            base = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            text = (" " if rng.random() < 0.5 else "\n").join(base)
        rows.append((i, text.upper() if rng.random() < 0.1 else text, "x"))
    return rows


def check(spark, rows):
    got = jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute([(i, t) for i, t, _ in rows if i is not None])
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    return got


@pytest.mark.parametrize("seed", range(2))
def test_as_brute_force(spark, seed):
    check(spark, corpus(250, seed))


def test_crowded_groups_and_large_clusters(spark, monkeypatch):
    """Every group is split into blocks, and clusters take two rounds."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    check(spark, corpus(260, 5, groups=3))


def test_edge_cases(spark):
    rows = [(0, None, None), (1, "", "x"), (2, " \n\t", "x"), (3, "one", "x"), (4, "ONE\n", "x"), (5, "one two", "x"),
            (6, "one two", "x"), (6, "one two", "x"), (7, "one two three", "x"), (8, "Ä b c d", "x"), (9, "ä b c d", "x"),
            (10, "a b c", "x"), (11, "a b c", "x")]
    check(spark, rows)
    got = jaccard_components(spark.createDataFrame([*rows, (None, "one", "x"), (None, None, "x")], SCHEMA)).collect()
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts(spark):
    rng = random.Random(8)
    base = [f"t{rng.randrange(10**6)}" for _ in range(40_000)]
    near, far = list(base), list(base)
    for i in range(0, 40_000, 60):
        near[i] = "x"  # two thousand n-grams differ
    for i in range(0, 40_000, 30):
        far[i] = "y"
    rows = [(1, " ".join(base), "a"), (2, " ".join(near), "a"), (3, " ".join(far), "a")]
    got = {r.doc_id: r.component_id for r in check(spark, rows)}
    assert got == {1: 1, 2: 1, 3: 3}


def test_one_of_each_group_stays(spark):
    rows = corpus(200, 9) + [(5000, None, None), (None, "a b c d", "n"), (5001, "only here now", "r"), (5001, "only here now", "r")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = brute([(i, t) for i, t, _ in rows if i is not None])
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        [str(i) for i, (_, c) in want.items() if i == c] + ["None"]
    )


def test_bounds_allow_every_link():
    for total in range(2, 400):
        for a in range(1, total):
            need = -(-90 * total // 190)
            if need <= min(a, total - a):
                assert total - 2 * need <= most_different(total)
    lows, blocks = size_classes()
    for low, high, k in zip(lows, lows[1:], blocks):
        assert k == 0 or k > most_different(2 * (high - 1))


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 120, (90, 2))]
    pairs += [(200 + i, 201 + i) for i in range(40)] + [(300, 301 + i) for i in range(30)] + pairs[:5]
    links = spark.createDataFrame([*pairs, (None, 3), (4, None)], "a long, b long")
    want = roots({x for p in pairs if p[0] != p[1] for x in p}, pairs)
    got = {r.member: r.root for r in components(links).collect()}
    assert got == want
    assert components(links.limit(0)).count() == 0


def test_lists_are_counted_and_ngrams_formed_once(spark, monkeypatch):
    """Not once for each cell of a list, nor for documents that are in no cluster."""
    plans, land = {}, ngram_join.land

    def landed(df, label, keep=False):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return land(df, label, keep)

    monkeypatch.setattr(ngram_join, "land", landed)
    check(spark, corpus(40, 3))
    shared = plans["shared"]
    explode = next(i for i, line in enumerate(shared) if "Generate explode(rows#" in line)
    assert not [line for line in shared[:explode] if "size(rows#" in line or "(rows#" in line]
    assert not [line for line in plans["sets"] if "Filter" in line and "xxhash64" in line]
    assert [line for line in plans["sets"] if "xxhash64" in line]
