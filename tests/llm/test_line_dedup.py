import random

from salesloom.llm.line_dedup import drop_boilerplate
from tests.llm.brute import without_boilerplate

SCHEMA = "doc_id long, text string, source string, N_lines long"


def pages(n, seed):
    rng = random.Random(seed)
    menu = ["Home | About", " Home | About ", "All rights reserved.", "\tSubscribe!", "Réservé"]
    rows = []
    for i in range(n):
        host = rng.choices(["a", "b", None], [5, 2, 1])[0]
        lines = [f"line {rng.randrange(400)} of text" for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 3)):
            lines.insert(rng.randint(0, len(lines)), rng.choice([*menu, "", " "]))
        rows.append((i, "\n".join(lines), host, 7))
    return rows


def test_as_brute_force(spark):
    rows = pages(600, 1) + [(1000, None, "a", 1), (1001, "", "a", 1), (1002, "\n \n", None, 1)]
    rows += [(2000 + i, "Home | About\nown line", "small", 1) for i in range(4)]  # too few pages
    out = drop_boilerplate(spark.createDataFrame(rows, SCHEMA), ratio=0.02)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    got = {r.doc_id: r for r in out.collect()}
    want = without_boilerplate([(t, h) for _, t, h, _ in rows], ratio=0.02)
    assert len(got) == len(rows)
    for (i, text, _, _), expected in zip(rows, want):
        assert got[i].text == expected
        lines = [x for x in (text or "").split("\n") if x.strip(" \t")]
        left = [x for x in (expected or "").split("\n") if x.strip(" \t")]
        assert (got[i].n_lines, got[i].n_dropped) == (len(lines), len(lines) - len(left))
    assert any(r.n_dropped for r in got.values()) and got[2000].text == "Home | About\nown line"


def test_edges(spark):
    assert drop_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "\n".join(f"row {i}" for i in range(100_000))
    rows = [(1, long, "h", 1), (1, long, "h", 1)] + [(i, "same", "h", 1) for i in range(2, 9)]
    got = drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.text for r in got if r.doc_id == 1] == [long, long]  # two pages are too few
    assert {r.text for r in got if r.doc_id > 1} == {""}
