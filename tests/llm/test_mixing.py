import itertools
import random

import pytest

from salesloom.llm.mixing import mix_sources, route, target_words


def test_targets_by_hand():
    assert target_words({"a": 100, "b": 100, "c": 100}) == {"a": 200.0, "b": 2 / 3 * 250, "c": 1 / 3 * 250}
    assert target_words({"a": 10, None: 10}) == {"a": 20.0, None: 10.0}
    assert target_words({}) == {} and target_words({"a": 0}) == {"a": 0.0}
    for seed in range(30):
        rng = random.Random(seed)
        sizes = {f"s{i}": rng.randint(0, 1000) for i in range(rng.randint(1, 9))}
        targets = target_words(sizes)
        assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-6
        assert all(t <= 2 * sizes[s] + 1e-9 for s, t in targets.items())


def cost(given, capacity):
    return sum(max(0, g - capacity[p]) for p, g in given.items())


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_largest_and_cheapest(seed):
    rng = random.Random(seed)
    patterns = rng.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("c",)], 3)
    capacity = {p: rng.randint(0, 4) for p in patterns}
    quotas = {s: rng.randint(0, 5) for s in "abc"}

    def served(given):
        """Whether the given words can be split over the quotas."""
        sources = list(quotas)
        for r in range(len(sources) + 1):  # Hall's condition
            for some in itertools.combinations(sources, r):
                if sum(g for p, g in given.items() if set(p) <= set(some)) > sum(quotas[s] for s in some):
                    return False
        return True

    options = [dict(zip(patterns, g)) for g in itertools.product(*[range(2 * capacity[p] + 1) for p in patterns])]
    options = [g for g in options if served(g)]
    most = max(sum(g.values()) for g in options)
    cheapest = min(cost(g, capacity) for g in options if sum(g.values()) == most)
    got = route(capacity, quotas)
    assert sum(got.values()) == most and served(got) and cost(got, capacity) == cheapest


def documents(n, seed=1):
    rng = random.Random(seed)
    weights = [("a", 6), ("b", 2), ("c", 2), (None, 1)]
    rows = []
    for i in range(n):
        s = rng.choices([w[0] for w in weights], [w[1] for w in weights])[0]
        members = [s] if rng.random() < 0.7 else [s, rng.choice("abc")]
        rows.append((i, rng.choice([0, 1, 5, 20, 100, 400]), members, "t"))
    return rows


def test_mix(spark):
    rows = documents(900)
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, Target string")
    out = mix_sources(docs)
    assert out.columns == ["doc_id", "size", "sources", "copies", "source_size", "target"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
    sizes = {}
    for r in got:
        for s in set(r.sources):
            sizes[s] = sizes.get(s, 0) + r.size
    taken = sum(r.size * r.copies for r in got)
    capacity = {}
    for r in got:
        p = tuple(sorted(set(r.sources), key=lambda s: (s is None, s or "")))
        capacity[p] = capacity.get(p, 0) + r.size
    flow = route(capacity, {s: round(t) for s, t in target_words(sizes).items()})
    assert abs(taken - sum(flow.values())) <= 0.01 * taken  # whole documents
    again = {r.doc_id: r.copies for r in mix_sources(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert {r.doc_id: r.copies for r in mix_sources(docs, seed=8).collect()} != again


def test_single_sources_reach_their_targets(spark):
    rows = [(i, size, m[:1], "t") for i, size, m, _ in documents(1200, 3)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, x string")).collect()
    for s in ("a", "b", "c", None):
        mine = [r for r in got if r.sources == [s]]
        target = mine[0].target
        assert abs(sum(r.size * r.copies for r in mine) - target) <= max(2, 0.01 * target)


def test_edge_cases(spark):
    schema = "doc_id long, size long, sources array<string>"
    rows = [(1, None, ["a"]), (2, 5, None), (3, 5, [None]), (None, 5, ["a"]), (4, 7, ["a", "a"]), (4, 7, ["a", "a"]), (5, 0, []), (6, 10**9, ["b"])]
    got = mix_sources(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    assert [r.copies for r in got if r.doc_id in (2, 5)] == [0, 0]
    assert len({r.copies for r in got if r.doc_id == 4}) == 1
    assert mix_sources(spark.createDataFrame([], schema)).count() == 0


def test_the_plan_needs_no_python_workers(spark, monkeypatch):
    """A plan of rows would be an RDD, read by more Python workers on each executor."""
    from pyspark import RDD

    made = []
    given = RDD._to_java_object_rdd
    docs = spark.createDataFrame(documents(50), "doc_id long, size long, sources array<string>, x string")
    monkeypatch.setattr(RDD, "_to_java_object_rdd", lambda rdd: made.append(rdd) or given(rdd))
    assert mix_sources(docs).count() == 50
    assert not made
