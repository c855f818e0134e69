"""Spelling variants: words within one edit of each other, and the usual form of a word among them.

Words meet in groups. Of two words that differ by one inserted, deleted or replaced code point, let `big` be the larger
length: they share their first big // 2 code points or their last, so every word has a key for either half and for either
length that the longer word may have. Keys are dealt to buckets by hash, and a bucket beyond BLOCK rows (a very frequent
half) is cut into blocks that are compared two by two, so that no task grows with a key.

Within a bucket the words of one `big` have a bit-sliced position index: for each position and letter a bit set of the
words with that letter there. A word is looked up by running along it with three sets, 64 words at a time: those that
agree so far, those with one letter replaced, and those that lack one letter, which are read one position behind. Words
with one letter more are the other side of the last set. Only what the sets leave at the end is ever listed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstream.llm.arrow import bound_batches
from millstream.session import stored

#: Rows of a bucket on average, and of a block at most on average; words that a task counts before it hands them on.
BUCKET, BLOCK, WORDS = 4096, 16384, 200_000
#: Numbers of 64 bits that the sets of one step hold at most.
_CELLS = 1 << 18
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def vocabulary(
    docs: DataFrame, text: str = "text", pattern: str = r"[A-Za-zÀ-ÿ]+", least_chars: int = 5, least: int = 3,
    key: str | None = None, change: Callable[[str, str], str] | None = None,
) -> DataFrame:
    """(word, n): the words of all texts with `least_chars` code points or more that occur `least` times or more.

    Words are the matches of `pattern`, in lower case as far as A to Z go. change(key, word) may replace a word, the same
    for all its places in a text; key is the row's `key` as text, '' where it is null. Null texts have no words.
    Tasks hand on counts, not places, and hold WORDS of them at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, totals = re.compile(pattern).findall, Counter()

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"])
            totals.clear()
            return made

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                for word, n in Counter(find(t.encode().translate(_LOWER).decode())).items():
                    if change is not None:
                        word = change(k, word)
                    if len(word) >= least_chars:
                        totals[word] += n
                if len(totals) >= WORDS:
                    yield rows()
        yield rows()

    bound_batches(docs.sparkSession)
    sent = docs.select((F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit("")).alias("k"), F.col(text).alias("t"))
    counts = sent.mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class PositionIndex:
    """Bit sets over words of two lengths, `big` and one less: for each position and letter the words that have it there."""

    def __init__(self, words: list[str], big: int):
        self.big, self.size = big, len(words)
        self.letters = np.array(words, dtype=f"U{big}").view(np.uint32).reshape(len(words), big)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.longer, self.shorter = self.bits(lengths == big), self.bits(lengths == big - 1)
        self.queries = np.flatnonzero(lengths == big)
        self.alphabets, self.sets = [], []
        for p in range(big):
            known, at = np.unique(self.letters[:, p], return_inverse=True)
            held = np.arange(len(known))[:, None] == at[None, :]
            self.alphabets.append(known)
            self.sets.append(np.concatenate([self.bits(held), self.bits(np.zeros((1, self.size), bool))]))

    def bits(self, mask: np.ndarray) -> np.ndarray:
        """Masks over the words as rows of 64-bit numbers."""
        packed = np.packbits(np.atleast_2d(mask), axis=1, bitorder="little")
        return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)

    def having(self, p: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the set of words that have it at position p; none for letters that no word has there."""
        known = self.alphabets[p]
        at = np.searchsorted(known, letters).clip(max=len(known) - 1)
        return self.sets[p][np.where(known[at] == letters, at, len(known))]

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(replaced, deleted): for each asked word of length `big` the sets of words that replace one letter, and that lack one."""
        q = self.letters[asked]
        equal = np.repeat(self.longer | self.shorter, len(asked), 0)
        replaced, lacking = np.zeros_like(equal), np.zeros_like(equal)
        for i in range(self.big):
            here = self.having(i, q[:, i])
            lacking = lacking & self.having(i - 1, q[:, i]) | equal if i else equal
            replaced = replaced & here | equal & ~here
            equal = equal & here
        return replaced & self.longer, lacking & self.shorter

    def pairs(self, outside: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(a, b, deleted): positions of near words; of replacements both directions, of deletions from the longer word.

        outside: for positions the sets of words that they may be paired with, if not all.
        """
        step = max(1, _CELLS // self.longer.shape[1])
        for at in range(0, len(self.queries), step):
            asked = self.queries[at : at + step]
            for found, deleted in zip(self.near(asked), (False, True)):
                if outside is not None:
                    found &= outside(asked)
                row, word = np.nonzero(found)
                if len(row):
                    hit, bit = np.nonzero(np.unpackbits(found[row, word][:, None].view(np.uint8), axis=1, bitorder="little"))
                    yield asked[row[hit]], word[hit] * 64 + bit, deleted


def _cells(vocabulary: DataFrame) -> DataFrame:
    """(bucket, i, j, block, big, side, key, word, n): the keys of each word, in cells of two blocks at most."""
    m, halves = F.length("word"), []
    for more in (0, 1):
        half = F.floor((m + more) / 2).cast("int")
        for side, part in enumerate((F.left("word", half), F.right("word", half))):
            halves.append(F.struct((m + more).alias("big"), F.lit(side).alias("side"), F.xxhash64(m + more, F.lit(side), part).alias("key")))
    buckets = max(1, -(-len(halves) * vocabulary.count() // BUCKET))
    keyed = vocabulary.select("word", "n", F.inline(F.array(*halves))).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    large = keyed.groupBy("bucket").count().filter(F.col("count") > BLOCK).select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = keyed.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "big", "side", "key", "word", "n")


def near(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words that differ by one code point, in both directions, each once.

    vocabulary: (word, n) with every word once and no nulls.
    """

    def run(table: pa.Table) -> pa.Table:
        made = {"word": [], "near": [], "near_n": []}
        big, side, key, n, block = (np.array(table[c], np.int64) for c in ("big", "side", "key", "n", "block"))
        words, two = table["word"], table["i"][0].as_py() != table["j"][0].as_py()
        for size in np.unique(big).tolist():
            at = np.flatnonzero(big == size)
            if len(at) < 2 or size == 0:
                continue
            own = words.take(pa.array(at)).to_pylist()
            index, half = PositionIndex(own, size), size // 2
            outside = None
            if two:
                blocks, where = np.unique(block[at], return_inverse=True)
                others = index.bits(where[None, :] != np.arange(len(blocks))[:, None])
                outside = lambda asked: others[where[asked]]
            for a, b, deleted in index.pairs(outside):
                # Words that share both halves meet twice, and are taken where their first halves meet.
                again = (index.letters[a, :half] == index.letters[b, :half]).all(axis=1) & (side[at[a]] == 1)
                kept = (key[at[a]] == key[at[b]]) & ~again
                for x, y in ((a[kept], b[kept]), (b[kept], a[kept]))[: 1 + deleted]:
                    made["word"] += [own[i] for i in x.tolist()]
                    made["near"] += [own[i] for i in y.tolist()]
                    made["near_n"] += n[at[y]].tolist()
        return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(made.items(), (pa.string(), pa.string(), pa.int64()))})

    return _cells(vocabulary).groupBy("bucket", "i", "j").applyInArrow(run, "word string, near string, near_n long")


def group(vocabulary: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its usual spelling.

    form is the near word of the largest n (of several the first in code-point order), if that is `times` the word's n or
    more, else null; root is where the forms lead in the end, the word itself if it has none. n_near counts the near words.
    vocabulary: (word, n); words that repeat count with the sum of their n, and null words, n or n under 1 are left out.
    times: 2 at least, so that forms lead upwards. An empty vocabulary gives no rows.
    """
    if times < 2:
        raise ValueError("times must be 2 at least")
    known = vocabulary.filter("word IS NOT NULL AND n >= 1").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    known = stored(known, "spelling-words")
    best = near(known).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    usual = -F.col("best.less") >= times * F.col("n")
    judged = known.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.near")).alias("form"), F.when(usual, -F.col("best.less")).alias("form_n"),
    )
    judged = stored(judged, "spelling-forms")
    roots = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round halves the way to the end
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = stored(roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("more")), "spelling-roots")
        if step.filter("more").isEmpty():
            break
        roots = step.select("word", "root")
    found = judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
