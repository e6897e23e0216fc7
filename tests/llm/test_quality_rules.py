import math
import random
import re
from collections import Counter

from salesloom.llm.quality_rules import log_ratios, quality_rules
from tests.llm.brute import words

SCHEMA = "doc_id long, text string, Kept string"


def measures(text):
    w, t = words(text), text or ""
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def corpus(n, seed):
    rng = random.Random(seed)
    common = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        w = rng.choices(common, k=rng.choice([0, 2, 30, 60, 200]))
        if i % 4 == 0:
            w = [x + rng.choice(["###", "|", "$&"]) for x in w]
        if i % 7 == 0:
            w = w[:8] * 12
        rows.append((i, "".join(x + rng.choice([" ", " ", "\n", "\t "]) for x in w), "x"))
    return rows


def test_measures_and_verdicts(spark):
    rows = corpus(240, 1) + [
        (900, None, "x"), (901, "", "x"), (902, " \n", "x"), (903, "a b c a b c a b c", "x"), (904, "é ü 漢字 🙂", "x"),
        (905, "x\n\n x\nx\nx", "x"), (906, " ".join(f"u{i % 9000}" for i in range(30_000)), "x"), (906, "again", "x"), (None, "a b", "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    trusted = spark.createDataFrame([(i,) for i in range(240) if i % 4] + [(None,), (1,)], "doc_id long")
    out = quality_rules(docs, trusted)
    assert out.columns == ["doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "score", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        m = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, r.doc_id
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert r.kept == (not r.base_failed and r.score >= -0.12)
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 240 and not r.base_failed]
    assert all(r.kept == (r.doc_id % 4 != 0) for r in judged) and len({r.kept for r in judged}) == 2


def test_ratios_count_all_rows(spark):
    rows = [(1, "a b"), (2, "a"), (3, None), (4, "c c c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (3,)], "doc_id long")
    got = {r.cell: r.ratio for r in log_ratios(docs, trusted, buckets=1 << 20).collect()}
    size = 1 << 20
    # n-grams: a, b, "a b"; a; c x 3, "c c" x 2
    in_both = math.log(2 / (size + 3)) - math.log(2 / (size + 9))
    values = Counter(round(v, 6) for v in got.values())
    assert values[round(in_both, 6)] >= 2  # b and "a b"
    assert values[round(math.log(2 / (size + 3)) - math.log(3 / (size + 9)), 6)] == 1  # a
    assert values[round(math.log(1 / (size + 3)) - math.log(4 / (size + 9)), 6)] == 1  # c


def test_nothing_trusted_and_nothing_at_all(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)), "x")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long")
    assert [(r.score, r.kept) for r in quality_rules(docs, none).collect()] == [(0.0, True)]
    assert quality_rules(docs.limit(0), none).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], SCHEMA)
    docs = docs.select("doc_id", "text")
    trusted = spark.range(3).withColumnRenamed("id", "doc_id")
    plan = quality_rules(docs, trusted)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
