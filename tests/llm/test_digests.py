"""Fingerprints equal a plain count of triplets; neighbours equal a sort of the whole table."""

import hashlib
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm import digests, neighbours, queries

M = 0xFFFFFFFF


def plain_digest(text):
    b = (text or "").encode()
    counts = [0] * digests.BUCKETS
    for i in range(len(b) - 2 * digests.GAP):
        h = (b[i] | b[i + digests.GAP] << 8 | b[i + 2 * digests.GAP] << 16) * 0x9E3779B1 & M
        h = (h ^ h >> 15) * 0x85EBCA6B & M
        counts[h >> 23] += 1
    ranked = sorted(counts)
    quarters = [ranked[len(counts) * q // 4 - 1] for q in (1, 2, 3)]
    codes = [sum(c > q for q in quarters) for c in counts]
    body = bytes(sum(codes[i + k] << 2 * k for k in range(4)) for i in range(0, len(codes), 4))
    return (bytes([min(255, round(6 * math.log2(1 + len(b))))]) + body).hex(), codes


def plain_likeness(a, b):
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    codes = lambda p: [c >> s & 3 for c in p[1:] for s in (0, 2, 4, 6)]
    apart = sum(abs(i - j) for i, j in zip(codes(x), codes(y))) + min(4 * abs(x[0] - y[0]), 128)
    return 1 - apart / (3 * digests.BUCKETS + 128)


def some_texts(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé漢") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def test_digest_equals_a_plain_count(monkeypatch):
    monkeypatch.setattr(digests, "_BYTES", 100)
    monkeypatch.setattr(digests, "_TEXTS", 7)
    texts = [*some_texts(30), None, "", "a", "ab", "abcdef", "abcdefg", "x" * 10_000]
    assert digests.digests(texts) == [plain_digest(t)[0] for t in texts]


def test_likeness(spark):
    texts = some_texts(20) + [None, ""]
    prints = digests.digests(texts)
    found = digests.alike([a for a in prints for _ in prints], [b for _ in prints for b in prints])
    assert found.tolist() == pytest.approx([plain_likeness(a, b) for a in prints for b in prints])
    assert all(0 <= x <= 1 for x in found.tolist()) and digests.alike(prints, prints).tolist() == [1.0] * len(prints)
    rows = [(prints[0], prints[1]), (None, prints[0]), ("zz", prints[0]), ("00", prints[0])]
    made = digests.likeness(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect()
    assert [r.likeness is None for r in made] == [False, True, True, True]


def test_edits_stay_near_and_other_texts_are_far():
    rng = random.Random(5)
    texts = [t for t in some_texts(60, 2) if len(t) > 500]
    same = [t.replace(" ", "  ", 1) for t in texts]
    half = [t[: len(t) * 9 // 10] + "".join(rng.choice("xyz ") for _ in range(len(t) // 10)) for t in texts]
    p = digests.digests(texts)
    near, edited = digests.alike(p, digests.digests(same)), digests.alike(p, digests.digests(half))
    far = digests.alike(p, digests.digests([t[::-1].upper() for t in texts]))
    assert near.min() > 0.9 and near.mean() > edited.mean() and (edited > far).all()


def test_fingerprint_column(spark):
    docs = spark.createDataFrame([(1, "some text here", "x"), (1, "some text here", "y"), (2, None, "z")], "doc_id long, text string, fingerprint string")
    rows = digests.fingerprint(docs).orderBy("doc_id").collect()
    assert rows[0].fingerprint == rows[1].fingerprint == plain_digest("some text here")[0] and rows[2].fingerprint == plain_digest("")[0]
    assert digests.fingerprint(docs.filter("false")).collect() == []


def following(spark, df, parts=None):
    def start():
        return lambda own, after: [pa.array([f"{a}>{b}" for a, b in zip(own[0].to_pylist(), after[0].to_pylist())], pa.string())]

    ordered = neighbours.in_order(df, F.col("k").asc_nulls_last(), F.col("v"))
    made = neighbours.add_from_next(ordered, ["v"], [T.StructField("pair", T.StringType())], start, ["k", "v"])
    return sorted(((r.k, r.v, r.pair) for r in made.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 400])
def test_next_rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 7, 7, *range(50)]), f"v{rng.randint(0, 9)}") for _ in range(n)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    expected = sorted(((k, v, f"{v}>{ordered[(i + 1) % n][1]}") for i, (k, v) in enumerate(ordered)), key=str)
    assert following(spark, spark.createDataFrame(rows, "k long, v string").repartition(5)) == expected


def test_rows_after_each_other_in_small_batches(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        test_next_rows(spark, 400)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_query_equals_a_plain_run(spark, tmp_path):
    texts = [*some_texts(40, 3), None, "", "é漢" * 20_000]
    rows = [(i * 3 % 43, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    made = {r.doc_id: r for r in queries.QUERIES["op13_digests"](spark, str(tmp_path)).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for at, (i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        own, other = plain_digest(t)[0], plain_digest(edited)[0]
        r = made[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), own, other)
        assert (r.near_edited, r.near_next) == pytest.approx((plain_likeness(own, other), plain_likeness(own, plain_digest(after)[0])))
    assert len(made) == len(rows)
