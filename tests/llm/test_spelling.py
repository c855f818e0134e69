"""Near words, forms and roots equal a comparison of all pairs; words are counted over whole texts."""

import random
import zlib
from collections import Counter

import pytest

from millstream.llm import spelling

WORDS = "word string, n long"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=2):
    found = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        found[w] = [form, w, n, len(near), counts[form] if form is not None else None]
    for w, row in found.items():
        while found[row[1]][0] is not None:
            row[1] = found[row[1]][0]
    return sorted((w, *row) for w, row in found.items())


def run(spark, rows, **kw):
    return sorted(tuple(r) for r in spelling.group(spark.createDataFrame(rows, WORDS), **kw).collect())


def some_words(n, letters="abcé", least=1, most=7, seed=1):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.randint(1, 40) for _ in range(n)}


def test_equals_all_pairs(spark):
    counts = some_words(400)
    assert run(spark, list(counts.items())) == brute(counts)


def test_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BUCKET", 32)
    monkeypatch.setattr(spelling, "BLOCK", 48)
    monkeypatch.setattr(spelling, "_CELLS", 8)
    # A third of the words share a first half of some length, so that its group is cut into many blocks.
    counts = some_words(300, seed=2) | {"xxxx" + w: n for w, n in some_words(200, "ab", 3, 5, 3).items()}
    assert run(spark, list(counts.items())) == brute(counts)


def test_index_finds_replaced_and_deleted_letters():
    words = ["abcde", "abcdf", "abde", "bcde", "abcd", "xbcde", "abcde", "acbde", "aacde"]
    index = spelling.PositionIndex(words, 5)
    found = {(words[a], words[b], d) for x, y, d in index.pairs() for a, b in zip(x.tolist(), y.tolist())}
    same = {(a, b, False) for a in words for b in words if len(a) == len(b) == 5 and one_edit(a, b)}
    less = {(a, b, True) for a in words for b in words if len(a) == 5 and len(b) == 4 and one_edit(a, b)}
    assert found == same | less


def test_forms_lead_to_roots_and_ties_go_to_the_first_word(spark):
    rows = [("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("ccccc", 5), ("ccccd", 10), ("bcccc", 10), ("lonely", 7), ("even", 3), ("eves", 5)]
    found = {r[0]: r[1:] for r in run(spark, rows)}
    assert found["aaaaa"][:2] == ("aaaab", "aabbb") and found["ccccc"] == ("bcccc", "bcccc", 5, 2, 10)
    assert found["lonely"] == (None, "lonely", 7, 0, None) and found["even"] == (None, "even", 3, 1, None)


def test_odd_rows(spark):
    long = "ab" * 3000
    rows = [("", 5), ("a", 1), ("b", 2), (None, 9), ("x", None), ("zero", 0), (long, 1), (long[:-1], 4), ("tie", 1), ("tie", 2), ("𝒂𝒃𝒄", 1), ("𝒂𝒃𝒅", 2)]
    assert run(spark, rows) == brute({"": 5, "a": 1, "b": 2, long: 1, long[:-1]: 4, "tie": 3, "𝒂𝒃𝒄": 1, "𝒂𝒃𝒅": 2})
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [("a", 1)], times=1)


def test_vocabulary_counts_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS", 5)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Alpha", "gamma9delta", "Éclair", "ÉCLAIR", "naïves", "tiny", "beta-beta"]) for _ in range(50)) for _ in range(20)]
    rows = list(enumerate([*texts, None, "", "alpha " * 30_000], 1)) + [(None, "alphas alphas alphas")]
    drop = lambda k, w: w if zlib.crc32(f"{k}:{w}".encode()) % 3 else w[:-1]
    expected = Counter()
    for i, t in rows:
        lower = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        found = "".join(c if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ" else " " for c in lower).split()
        expected.update(drop("" if i is None else str(i), w) for w in found)
    expected = {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = spelling.vocabulary(docs, key="doc_id", change=drop)
    assert {r.word: r.n for r in made.collect()} == expected
    assert spelling.vocabulary(docs.filter("false")).collect() == []
