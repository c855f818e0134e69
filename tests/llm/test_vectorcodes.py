"""Codes and codebooks equal plain Lloyd rounds that compare every part with every entry."""

import math
import random

import numpy as np
import pytest

from millstream.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label string"


def brute(rows, parts, entries, rounds):
    """{position in rows: (codes, errors)} and the codebooks, with plain Python numbers."""
    good = [(i, [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(v) for _, v in good), default=0) // parts)
    good = [(i, v + [0] * (parts * width - len(v))) for i, v in good]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    order = sorted(good, key=lambda g: (rows[g[0]][0] is None, rows[g[0]][0] or 0, g[1]))
    books = [[cut(v, p) for _, v in order[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c)), j) for j, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v in good:
                held.setdefault(near(v, p)[1], []).append(cut(v, p))
            for j, members in held.items():
                books[p][j] = [math.floor(sum(col) / len(members)) for col in zip(*members)]
    return {i: ([near(v, p)[1] for p in range(parts)], [near(v, p)[0] for p in range(parts)]) for i, v in good}, books


def agree(spark, rows, parts, entries, rounds):
    made, books = vectorcodes.compress(spark.createDataFrame(rows, SCHEMA).coalesce(3), parts=parts, entries=entries, rounds=rounds)
    found, expected = brute(rows, parts, entries, rounds)
    assert books.tolist() == expected
    key = lambda r: str(r)
    assert sorted(((r.vec_id, r.codes, r.errors, r.label) for r in made.collect()), key=key) == sorted(((rows[i][0], c, e, rows[i][2]) for i, (c, e) in found.items()), key=key)


def vectors(n, width, seed=1, step=8):
    rng = random.Random(seed)
    return [(i, [rng.randint(-step, step) / 16 for _ in range(width)], "x") for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_equals_plain_lloyd(spark, rounds):
    agree(spark, vectors(300, 12), 4, 16, rounds)


def test_ties_and_copies(spark):
    rows = vectors(60, 4, step=1) + [(i, [0.5] * 4, "copy") for i in range(100, 160)]
    agree(spark, rows, 2, 8, 3)


def test_active_entries_equal_a_rescan():
    rng = np.random.default_rng(7)
    x, book = rng.integers(-5, 6, (4000, 2)), rng.integers(-5, 6, (32, 2))
    code, far = vectorcodes.rescan(x, book)
    for share in (0, 0.1, 0.5, 1):
        moved = rng.random(32) < share
        after = np.where(moved[:, None], book + rng.integers(-1, 2, book.shape), book)
        got, expected = vectorcodes.update(x, after, moved, code, far), vectorcodes.rescan(x, after)
        assert (got[0] == expected[0]).all() and (got[1] == expected[1]).all()


def test_odd_vectors_take_no_part(spark):
    bad = [(50, None, "a"), (51, [None, 1.0, 1.0, 1.0], "b"), (52, [math.nan] * 4, None), (54, [math.inf, 0.0, 0.0, 0.0], "d")]
    agree(spark, vectors(12, 4) + bad + [(None, [1.0] * 4, None)], 2, 4, 2)


def test_lengths_that_do_not_fit(spark):
    agree(spark, vectors(20, 7) + [(100, [0.25], "short"), (101, [], "none")], 4, 8, 2)


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    agree(spark, [(i, [float(np.float32(rng.uniform(-1e6, 1e6))) for _ in range(8)], "x") for i in range(80)], 4, 8, 2)
    made, _ = vectorcodes.compress(spark.createDataFrame([(1, [1e30, 0.0], "x"), (2, [-1e30, 0.0], "x")], SCHEMA), parts=2, entries=1, rounds=0)
    assert sorted(r.errors[0] for r in made.collect()) == [0, (2 * (math.isqrt(1 << 61) // 2)) ** 2]


def test_few_and_no_rows_and_clashing_names(spark):
    agree(spark, vectors(1, 4), 2, 64, 2)
    made, books = vectorcodes.compress(spark.createDataFrame([], SCHEMA))
    assert made.collect() == [] and made.columns == ["vec_id", "embedding", "label", "codes", "errors"] and books.shape == (16, 0, 0)
    clashing = spark.createDataFrame([(1, [1.0, 2.0], "kept", "old")], "vec_id long, embedding array<float>, v string, codes string")
    row = vectorcodes.compress(clashing, parts=2)[0].first()
    assert (row.v, row.codes, row.errors) == ("kept", [0, 0], [0, 0])
