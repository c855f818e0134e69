"""Nearest vectors equal a brute-force search, with ties, copies, odd vectors and few rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millstream.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label string"


def brute(rows, every, k):
    good = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = []
    for q in good:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def run(spark, rows, every, k):
    numbers = topk.whole_numbers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in topk.nearest(numbers, k).collect())


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.randint(-8, 8) / 16 for _ in range(width)], "x") for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 64)
    monkeypatch.setattr(topk, "QUERIES", 16)
    rows = vectors(300, 9)
    assert run(spark, rows, 7, 5) == brute(rows, 7, 5)


@pytest.mark.parametrize("width", [1, 2, 6])
def test_ties_and_copies(spark, width):
    rows = vectors(40, width) + [(i, [0.5] * width, "copy") for i in range(100, 160)]
    assert run(spark, rows, 4, 5) == brute(rows, 4, 5)


def test_odd_vectors_take_no_part(spark):
    rows = vectors(12, 4) + [(50, None, "a"), (51, [None, 1.0, 1.0, 1.0], "b"), (52, [math.nan] * 4, "c"), (54, [math.inf, 0.0, 0.0, 0.0], "d"), (None, [1.0] * 4, "e")]
    assert run(spark, rows, 2, 3) == brute(rows, 2, 3)


def test_repeated_rows_count_once_and_short_vectors_are_filled(spark):
    rows = [(0, [1.0, 1.0], "a"), (0, [1.0, 1.0], "a"), (1, [1.0], "b"), (2, [0.5, 0.5], "c"), (2, [0.5, 0.5], "d")]
    assert run(spark, rows, 2, 5) == [(0, 1, 1, 65536), (0, 2, 2, 65536), (2, 1, 0, 65536), (2, 2, 1, 32768)]


def by_rows(rows, every, k):
    """`brute` over rows, of which several may share an id: all but the query's own are candidates."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows]
    found = []
    for at, (q, w) in enumerate(good):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v)), i) for n, (i, v) in enumerate(good) if n != at)
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("shared", [[4, 4, 8, 11], [5, 10, 10]])
def test_rows_that_share_an_id_are_rows_of_their_own(spark, shared):
    rows = vectors(30, 6)
    rows += [(i, v, "again") for (_, v, _), i in zip(vectors(len(shared), 6, seed=2), shared)]  # another vector
    numbers = topk.whole_numbers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in topk.nearest(numbers, 5).collect()) == by_rows(rows, 5, 5)


def test_query_takes_every_row_but_its_own(spark, tmp_path):
    from millstream.llm.queries import QUERIES

    rows = vectors(120, 6)
    rows += [rows[i] for i in (3, 3, 7, 50, 50, 99)] + [(7, rows[9][1], "other"), (100, rows[11][1], "other")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in QUERIES["op7_topk"](spark, str(tmp_path)).collect())
    assert got == by_rows(rows, 50, 5)


def test_few_and_no_rows(spark):
    assert run(spark, vectors(1, 3), 1, 5) == []
    assert run(spark, vectors(3, 3), 1, 5) == brute(vectors(3, 3), 1, 5)
    empty = topk.whole_numbers(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0)
    assert topk.nearest(empty, 5).collect() == []
