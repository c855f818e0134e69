"""Lines that go equal those of a comparison of all pairs."""

import random

import pytest

import corpus_pipeline
from millstream.llm import lines

SCHEMA = "doc_id long, text string, n_lines string, h int"


def near(a, b):
    """Edit distance over words of 1 at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=lines.LEAST_WORDS, close=lines.NEAR_WORDS):
    """Rows of documents whose ids are distinct or whose texts are equal."""
    docs = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None})
    every = [((has, i), n, tuple(x for x in line.replace("\t", " ").replace("\r", " ").split(" ") if x)) for has, i, text in docs for n, line in enumerate(text.split("\n"))]
    first = {}
    for doc, n, w in every:
        first.setdefault(w, (doc, n))
    gone = set()
    for doc, n, w in every:
        if len(w) >= least and (first[w] < (doc, n) or any(f < first[w] and max(len(v), len(w)) >= close and len(v) >= least and near(v, w) for v, f in first.items())):
            gone.add((doc, n))
    out = []
    for i, text in rows:
        parts = [] if text is None else text.split("\n")
        kept = [x for n, x in enumerate(parts) if ((i is not None, i or 0), n) not in gone]
        out.append((i or 0, None if text is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows):
    made = lines.dedup(spark.createDataFrame([(*r, "mine", 3) for r in rows], SCHEMA))
    assert set(made.columns) == {"doc_id", "text", "h", "n_lines", "n_dropped"}
    return sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in made.collect()), key=str)


def line(rng):
    return [f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 4, 5, 6, 7, 8, 9, 10, 15, 40]))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    pool, rows = [], []
    for i in range(80):
        own = []
        for _ in range(rng.randrange(1, 7)):
            if pool and rng.random() < 0.7:
                w = list(rng.choice(pool))
                for _ in range(rng.choice([0, 1, 1, 2])):
                    at = rng.randrange(len(w) + 1)
                    w[at : at + rng.choice([0, 1])] = [f"x{rng.randrange(9)}"] * rng.choice([0, 1])
            else:
                w = line(rng)
            pool.append(w)
            own.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(own)))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    same = "one two three four five six seven eight nine"
    swap = "two one three four five six seven eight nine"
    rows = [(1, same), (2, None), (3, ""), (4, f"{swap}\n{same} ten\n\n"), (5, "a b\na b\na b"), (6, f"{same}\n{same}"), (6, f"{same}\n{same}"), (None, f"{same} x"), (9, "é " * 9)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_pipeline_drops_short_repeats(spark):
    """Exact repeats of any line that isn't empty go in the pipeline, also of a line without blanks."""
    link = "https://example.org/" + "x" * 300
    chinese = "這是一行沒有空格的文字而且重複出現"
    rows = [(1, f"Les.\n\n{link}"), (2, f"Les.\n\nown words\n{link}"), (3, f"{chinese}\nOf, edti  oner.\n"), (4, f"{chinese}\nOf, edti oner.\nlast"), (5, "Les."), (6, "\n \n")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, df, "").collect()}
    assert kept == {1: rows[0][1], 2: "\nown words", 3: rows[2][1], 4: "last", 6: "\n \n"}


def test_long_lines(spark):
    words = [f"w{i}" for i in range(30_000)]
    other = words[:20_000] + ["new"] + words[20_001:]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(other[:100] + ["third"] + other[100:])), (4, " ".join(words[::-1]))]
    got = run(spark, rows)
    assert [(r[0], r[3]) for r in got] == [(1, 0), (2, 1), (3, 1), (4, 0)]


def test_many_lines_of_one_form(spark):
    """A template of which only one word differs: all but the earliest go, without pairs."""
    rows = [(i, f"the user of this long line has the number n{i} today") for i in range(500)]
    assert sum(r[3] for r in run(spark, rows)) == 499
