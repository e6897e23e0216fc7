import random

import numpy as np

from salesloom.llm.weak_quality import (
    ABSTAIN, BAD, GOOD, LABELLERS, classify, expectation_maximisation, measure, train, trigrams, unpack, votes,
)

GOOD_WORDS = "river stone morning window garden little paper under often bright market story".split()


def prose(rng, n):
    words = [rng.choice(GOOD_WORDS) + "abcdefgh"[rng.randrange(8)] for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 7]).capitalize() for i in range(0, n, 7)) + "."


def spoil(rng, text):
    if rng.random() < 0.5:
        return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split())
    return " ".join(w.upper() + "!!" for w in text.split())


def corpus(n, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        text, good = prose(rng, rng.randint(30, 200)), rng.random() < 0.8
        rows.append((i, text if good else spoil(rng, text), good))
    return rows


def test_measures_by_hand():
    m = measure("Ab cd!\nAb cd!\n### 12 é.")
    assert m.words == 7
    assert abs(m.word_length - 17 / 7) < 1e-12  # code points
    assert (m.symbols, m.shouts, m.digits, m.bare) == (3 / 7, 2 / 7, 2 / 7, 1 / 7)
    assert (m.upper, m.letters) == (2 / 9, 9 / 17)
    assert abs(m.repeated - 1 / 3) < 1e-12 and m.distinct == 5 / 7 and m.twice == 0


def test_patterns_go_both_ways():
    for text in ("a", prose(random.Random(2), 40), "### ### ###"):
        m = measure(text)
        assert unpack(np.array([votes(text)]))[0].tolist() == [f(m) for f in LABELLERS.values()]
    assert votes(None) == votes("") == votes(" \n") == -1


def test_trigrams_stay_in_the_table():
    for buckets in (1 << 6, 1 << 15):
        cells = trigrams("déjà vu " * 50, buckets)
        assert len(cells) == len(("déjà vu " * 50).encode()) and cells.max() < buckets


def test_accuracies_are_found_again():
    rng = np.random.default_rng(7)
    n, truth = 40_000, None
    truth = rng.random(n) < 0.8
    rates = [(0.9, 0.02), (0.7, 0.01), (0.6, 0.03), (0.8, 0.01)]  # votes bad on bad and on good
    cast = np.stack([np.where(rng.random(n) < np.where(truth, g, b), BAD, GOOD) for b, g in rates], axis=1)
    cast[rng.random(cast.shape) < 0.1] = ABSTAIN
    rows, counts = np.unique(cast, axis=0, return_counts=True)
    chance, chances, share = expectation_maximisation(rows, counts.astype(float))
    voted = chances[:, :, 1] / chances[:, :, 1:].sum(axis=2)
    # The belief of a tenth pulls the estimates a little towards it.
    assert np.abs(voted[1] - [g for _, g in rates]).max() < 0.02
    assert np.abs(voted[0] - [b for b, _ in rates]).max() < 0.15
    assert abs(share - 0.8) < 0.03
    by_row = {tuple(r): c for r, c in zip(rows.tolist(), chance)}
    said = np.array([by_row[tuple(r)] >= 0.5 for r in cast.tolist()])
    assert (said == truth).mean() > 0.97


def test_operator(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in rows], "doc_id long, text string, Kept string")
    scorer = train(docs, docs_per_side=60)
    fresh = corpus(300, seed=9)
    more = [(i, t, "k") for i, t, _ in fresh] + [(900, None, None), (901, "", "x"), (902, " \t", "x"),
            (903, prose(random.Random(4), 60_000), "x"), (903, prose(random.Random(4), 60_000), "x"), (None, "a b", "x")]
    out = classify(spark.createDataFrame(more, docs.schema), scorer)
    assert out.columns == ["doc_id", "text", "score", "kept"]
    got = out.collect()
    assert len(got) == len(more)
    by_id = {r.doc_id: r for r in got}
    right = [by_id[i].kept == good for i, _, good in fresh]
    assert np.mean(right) > 0.97
    assert all((by_id[i].score, by_id[i].kept) == (0.0, False) for i in (900, 901, 902))
    assert len({r.score for r in got if r.doc_id == 903}) == 1 and by_id[903].kept
    again = train(docs.repartition(6), docs_per_side=60)
    np.testing.assert_allclose(again.weights, scorer.weights)
    assert train(docs.limit(0)) is None
    assert classify(docs.limit(0), None).count() == 0
    assert {r.score for r in classify(docs, None).collect()} == {1.0}


def test_expectation_maximisation_as_brute_force():
    """One document at a time, in plain loops, for the same number of rounds."""
    from math import exp, log

    from salesloom.llm.weak_quality import BELIEF, BELIEVED, GOOD_SHARE

    rng = random.Random(6)
    docs = []
    for _ in range(400):
        good = rng.random() < 0.7
        docs.append(tuple(
            ABSTAIN if rng.random() < 0.3 else (GOOD if good == (rng.random() < right) else BAD)
            for right in (0.95, 0.85, 0.75, 0.6)
        ))
    patterns = sorted(set(docs))
    cast, counts = np.array(patterns), np.array([docs.count(p) for p in patterns], float)
    rounds = 7
    chance, chances, share = expectation_maximisation(cast, counts, rounds)

    kinds = (ABSTAIN, BAD, GOOD)
    table = [[[BELIEVED[c][v] for v in range(3)] for _ in range(4)] for c in range(2)]
    part, believed = GOOD_SHARE, BELIEF * len(docs) + 1
    for _ in range(rounds):
        posterior = []
        for doc in docs:
            logs = [log(1 - part), log(part)]
            for c in range(2):
                for j, vote in enumerate(doc):
                    logs[c] += log(table[c][j][kinds.index(vote)])
            posterior.append(1 / (1 + exp(logs[0] - logs[1])))
        for c in range(2):
            prior = believed * (GOOD_SHARE if c else 1 - GOOD_SHARE)
            for j in range(4):
                sums = [prior * BELIEVED[c][v] for v in range(3)]
                for doc, p in zip(docs, posterior):
                    sums[kinds.index(doc[j])] += p if c else 1 - p
                table[c][j] = [x / sum(sums) for x in sums]
        part = (sum(posterior) + believed * GOOD_SHARE) / (len(docs) + believed)

    by_pattern = dict(zip(docs, posterior))
    assert np.allclose(chance, [by_pattern[p] for p in patterns], atol=1e-9)
    assert np.allclose(chances, table, atol=1e-9) and abs(share - part) < 1e-9
