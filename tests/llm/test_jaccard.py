"""Components equal those of a brute-force join of n-gram sets."""

import random

import pytest
from pyspark.sql import functions as F

from millstream.llm import jaccard
from millstream.llm.components import components

SCHEMA = "doc_id long, text string, row string, s int, _in0 int"


def grams(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    words = [w for x in words for w in x.replace("\n", " ").replace("\t", " ").split(" ") if w]
    return set(map(tuple, ([words] if 0 < len(words) < n else [words[i : i + n] for i in range(len(words) - n + 1)] if words else [])))


def brute(rows, n, num):
    sets = [grams(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= num * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0] is None, r[0] or 0, len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def run(spark, rows, n, num):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.similar(df, n, num).collect()), key=str)


def corpus(seed, n=260):
    """Texts of every size with copies after a few edits, and one passage that many share."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = (rng.choice(rows)[1] or "a").split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.choice([0, 1])] = [f"w{rng.randrange(2000)}"] * rng.choice([0, 1])
                words = words or ["z"]
        else:
            words = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 30, 60, 120, 400]))]
            words += passage.split() if rng.random() < 0.4 else []
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80), (1, 50)])
def test_equals_brute_force(spark, monkeypatch, n, num):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = corpus(n)
    assert run(spark, rows, n, num) == brute(rows, n, num)


def test_odd_rows(spark):
    rows = [(1, "A b C"), (2, "a B\tc"), (2, "other text here now"), (3, ""), (4, None), (5, " \n "), (5, " \n "), (None, "a b c"), (None, "lone words"), (7, "two words"), (8, "TWO words"), (9, "É b c"), (10, "é b c")]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert run(spark, [], 3, 90) == []


def test_long_text_and_many_copies(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(i, f"same words in all of these texts {i % 3}") for i in range(300)] + [(1000, long), (1001, long + " more")]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_similar_sets_always_meet():
    """Any pair within the similarity has a meeting place, also with empty segments."""
    import numpy as np

    rng = np.random.default_rng(3)
    for num in (50, 80, 90, 95):
        scheme = jaccard.Scheme(num)
        for _ in range(1500):
            n = int(rng.integers(1, 80))
            x = rng.integers(0, 2**64, n, dtype=np.uint64)
            most = (100 - num) * n // num
            lost = int(rng.integers(0, most + 1))
            y = np.concatenate([x[int(rng.integers(0, lost + 1)) :], rng.integers(0, 2**64, lost, dtype=np.uint64)])
            x, y = np.unique(x), np.unique(y)
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= num * (len(x) + len(y) - both):
                assert set(scheme.keys(x).tolist()) & set(scheme.keys(y).tolist())


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (5, ""), (6, None), (7, "quite another text than that"), (None, "no id but words in it")]
    df = spark.createDataFrame([(*r, f"x{i}", i, 2) for i, r in enumerate(rows)], SCHEMA)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.s) for r in kept.collect()) == [(0, 6), (1, 1), (5, 3), (6, 4), (7, 5)]


def test_keep_one_goes_by_component_not_by_key(spark):
    """One key over texts that aren't near each other keeps them all; near copies without key are one."""
    first, other = " ".join(f"u{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    lone = " ".join(f"n{i}" for i in range(40))
    rows = [(1, first), (1, other), (2, first + " more"), (None, lone), (None, lone + " more"), (None, lone), (None, other + " more")]
    df = spark.createDataFrame([(*r, "x", i, 2) for i, r in enumerate(rows)], SCHEMA)
    kept = sorted(r.s for r in jaccard.keep_one(df).collect())
    assert kept[:2] == [0, 1] and len(kept) == 3 and kept[2] in (3, 4)


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(500, 400), (7, 7), (None, 1)], "a long, b long"))
    found = {r.s: r.c for r in components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {500: 400, 400: 400}


def family(n, seed=5, words=300, edits=4):
    """One text and its variants, which are near it, and mostly not near each other."""
    rng = random.Random(seed)
    first = [f"o{i}" for i in range(words)]
    rows = [(0, " ".join(first))]
    for i in range(1, n):
        own = list(first)
        for at in rng.sample(range(words), edits):
            own[at] = f"v{i}x{at}"
        rows.append((i, " ".join(own)))
    return rows


def test_rows_grow_with_the_members_of_a_group(spark, monkeypatch):
    """A text and 800 variants: what is compared and linked stays a small multiple of them, not of their pairs."""
    written, plain = {}, jaccard.stored

    def counted(df, label):
        made = plain(df, label)
        written[label] = written.get(label, 0) + made.count()
        return made

    monkeypatch.setattr(jaccard, "stored", counted)
    rows = family(801)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    assert {r.component_id for r in jaccard.similar(df, 3, 90).collect()} == {0}
    assert written["jaccard-sized"] <= 3 * 801 and written["jaccard-forest"] < 801 and written["jaccard-survivors"] <= 2 * 801


def test_left_over_members_are_linked_in_cells(spark, monkeypatch):
    """Without rounds of stars beyond the first, and with small blocks, the cells find what the stars left."""
    monkeypatch.setattr(jaccard, "STARS", 1)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(9)
    rows = corpus(11, 150) + [(1000 + i, t) for i, (_, t) in enumerate(family(30, 6, 60, 1))]
    # Chains: each text is near the one before only.
    words = [f"c{i}" for i in range(100)]
    for i in range(40):
        at = rng.randrange(len(words))
        words = [*words[:at], f"d{i}", *words[at + 1 :]]
        rows.append((2000 + i, " ".join(words)))
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_sketches_that_say_too_much_are_corrected(spark, monkeypatch):
    """With sketches that make all sets of a size alike, cells are worked out from whole sets."""
    monkeypatch.setattr(jaccard, "_sketch", lambda grams: bytes(2 * len(grams)))
    monkeypatch.setattr(jaccard, "STARS", 1)
    rows = corpus(12, 120)
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


@pytest.mark.parametrize("bits", [3, 40])
def test_cut_meeting_places_lose_and_add_nothing(spark, monkeypatch, bits):
    """Where places aren't kept, their beginnings are counted first; however many of these are equal, the rows are the same."""
    rng = random.Random(8)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(40)) for _ in range(6)]
    texts = base + [t + " more" for t in base] + base[:2] + ["", None, "short one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "CUT_BITS", bits)
    of = lambda kept: sorted(map(tuple, jaccard.similar(df, store_keys=kept).drop("row").collect()), key=str)
    assert of(False) == of(True)
