"""Line dedup within one edited word, by a deletion-neighbourhood join.

A line is its words in order. Two lines are within the bound if they are equal, or one word inserted, deleted or
replaced turns one into the other: then for some place p both without the word at p are equal, or one without it is the
other. So a line of m words has the keys (p, the line without its word at p) and, as the shorter one of a pair, (p, the
line itself). Lines with a common key are all within the bound of each other, whatever their number, so it is enough to
know the earliest line of each key: no pairs are listed. Keys are sums of hashes of (word, place), so that all keys of a
line cost one pass over its words. A line whose key has an earlier line is compared with it word by word before it goes.

Keys are made only of lines that can have a partner, and only for the places where the edit can lie. Of two lines
within the bound, the longer of M words, the first or the last floor(M / 2) words are equal. These halves are hashed for
all lines; a line none of whose halves is another line's goes no further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.llm.sieve import keeper
from millstream.session import stored

#: Lines of fewer words are never dropped; from this many on, equal lines are. Empty lines always stay.
LEAST_WORDS = 1
#: Pairs whose longer line has fewer words must be equal; from this many on, one word may differ.
NEAR_WORDS = 8
#: Hashes of words are cut to so many values that their sum over a line can't overflow.
_ROOM = 1 << 40


def plain(line: Column) -> Column:
    """A line with single blanks between words and none around. Most lines are so already, which is cheap to see."""
    odd = F.contains(line, F.lit("  ")) | F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r"))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\r]+", " ")).otherwise(line))


def _identity(key: str, text: str) -> list[Column]:
    """Identity of a document: rows that repeat key and text are one document."""
    return [F.col(key).alias("id"), F.xxhash64(F.lit(0), key, text).alias("doc")]


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, doc, n, line, m): lines in plain form with their place from 0 and their number of words; none for null texts."""
    # An outer explode: for a plain one Spark would test the list's size first, and split the text anew for that.
    rows = docs.select(*_identity(key, text), F.posexplode_outer(F.split(F.col(text), "\n")).alias("n", "raw")).filter("n IS NOT NULL")
    rows = rows.select("id", "doc", "n", plain(F.col("raw")).alias("line"))
    return rows.withColumn("m", F.when(F.col("line") == "", 0).otherwise(F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1))


def _half_keys(line: Column, m: Column) -> Column:
    """Hashes of the halves, with the place of the key: first and last half as the longer line, then as the shorter."""
    made = []
    for longer in (m, m + 1):
        k = F.floor(longer / 2).cast("int")
        first = F.call_function("substring_index", line, F.lit(" "), k)
        last = F.call_function("substring_index", line, F.lit(" "), -k)
        made += [F.xxhash64(F.lit(1), longer, first), F.xxhash64(F.lit(2), longer, last)]
    return F.array(*made)


def _partners(numbers: DataFrame, near_words: int) -> DataFrame:
    """(h, t0 to t3): lines with a half in common with another line, and which of the four keys that is."""
    near = numbers.filter(F.size("halves") > 0)
    able = F.when(F.col("m") >= near_words, F.col("halves")).otherwise(F.concat(F.array_repeat(F.lit(None).cast("long"), 2), F.slice("halves", 3, 2)))
    keys = near.select("h", F.posexplode(able).alias("t", "half")).filter("half IS NOT NULL")
    groups = keys.groupBy("half").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.min("t").alias("t"))
    shared = stored(groups.filter("a <> b AND t < 2").select("half"), "lines-halves")  # one of a pair is the longer
    found = keeper(shared, "half")(keys, F.col("half")).distinct().join(shared, "half")
    return found.groupBy("h").agg(*[F.max(F.col("t") == t).alias(f"t{t}") for t in range(4)])


def _keys(lines: DataFrame) -> DataFrame:
    """(key, h): keys of lines (h, line, m, t0 to t3), at the places where the edit can lie."""
    words = lines.repartition("h").select("h", "m", "t0", "t1", "t2", "t3", F.posexplode(F.split("line", " ")).alias("p", "w"))
    upto = Window.partitionBy("h").orderBy("p")
    whole = Window.partitionBy("h")
    sums = words
    for i in (1, 2):  # two sums make one key, as one of them alone could meet another by chance
        here, shifted = (F.pmod(F.xxhash64(F.lit(i), "w", F.col("p") - d), F.lit(_ROOM)) for d in (0, 1))
        sums = sums.withColumns({f"a{i}": here, f"b{i}": shifted})
    made = {}
    for i in (1, 2):
        made[f"before{i}"] = F.sum(f"a{i}").over(upto) - F.col(f"a{i}")
        made[f"after{i}"] = F.sum(f"b{i}").over(whole) - F.sum(f"b{i}").over(upto)
        made[f"all{i}"] = F.sum(f"a{i}").over(whole)
    sums = sums.withColumns(made)
    p, m = F.col("p"), F.col("m")

    def lies(at: Column, longer: Column, first: str, last: str) -> Column:
        k = F.floor(longer / 2)
        return (F.col(first) & (at >= k)) | (F.col(last) & (at <= longer - 1 - k))

    def key(at: Column, left: Column, right: Column) -> Column:
        return F.xxhash64(at, left, right)

    deleted = F.when(lies(p, m, "t0", "t1"), key(p, F.col("before1") + F.col("after1"), F.col("before2") + F.col("after2")))
    inserted = F.when(lies(p, m + 1, "t2", "t3"), key(p, F.col("all1"), F.col("all2")))
    at_end = F.when((p == m - 1) & lies(m, m + 1, "t2", "t3"), key(m, F.col("all1"), F.col("all2")))
    return sums.select("h", F.explode(F.array_compact(F.array(deleted, inserted, at_end))).alias("key"))


def _same_words(a: Column, b: Column) -> Column:
    """How many leading words of two lists are equal."""
    unequal = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(unequal == 0, F.size(a)).otherwise(unequal - 1)


def _within_one(a: Column, b: Column) -> Column:
    """Whether one word at most is inserted, deleted or replaced: the equal words at both ends leave no more than one."""
    return _same_words(a, b) + _same_words(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(id, doc, n): the lines that go, by document and place.

    Of equal lines the earliest stays, by (key, hash of the document, place), nulls first; and a line goes with all its
    copies where an earlier line lies within the bound, whether or not that one goes itself.
    """
    lines = lines_of(docs, key, text)
    halves = F.when(F.col("m") >= max(near_words - 1, 2), _half_keys(F.col("line"), F.col("m"))).otherwise(F.array().cast("array<bigint>"))
    numbers = stored(lines.select("id", "doc", "n", F.xxhash64("line").alias("h"), F.col("m"), halves.alias("halves")), "lines-numbers")
    numbers = numbers.filter(F.col("m") >= least_words)
    same = numbers.groupBy("h").agg(F.min(F.struct("id", "doc", "n")).alias("first"), F.count("*").alias("copies"))
    partners = stored(_partners(numbers, near_words).join(same, "h"), "lines-partners")
    # One copy of the text of each line that can have a partner.
    texts = keeper(partners, "h")(lines.select(F.xxhash64("line").alias("h"), "m", "line"), F.col("h"))
    texts = stored(texts.groupBy("h").agg(F.min("m").alias("m"), F.min("line").alias("line")).join(partners, "h"), "lines-texts")
    keys = _keys(texts)
    groups = keys.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    groups = stored(groups, "lines-keys")
    held = keeper(groups, "key")(keys, F.col("key")).join(groups, "key").join(texts.select("h", "first"), "h")
    held = stored(held, "lines-held")
    earliest = held.groupBy("key").agg(F.min(F.struct("first", "h")).alias("best"))
    pairs = held.join(earliest, "key").filter("best.first < first").select("h", F.col("best.h").alias("earlier")).distinct()
    words = texts.select("h", F.split("line", " ").alias("w"))
    compared = pairs.join(words, "h").join(words.select(F.col("h").alias("earlier"), F.col("w").alias("v")), "earlier")
    near = compared.filter(_within_one(F.col("w"), F.col("v"))).select("h").distinct().withColumn("near", F.lit(True))
    gone = same.filter("copies > 1").join(near, "h", "full").select("h", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = stored(gone, "lines-gone")
    found = keeper(gone, "h")(numbers.select("id", "doc", "n", "h"), F.col("h")).join(gone, "h")
    return found.filter(F.col("near") | (F.struct("id", "doc", "n") > F.col("first"))).select("id", "doc", "n")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """`docs` with `text` without the lines that go, and with `n_lines` and `n_dropped` (long; replaced if there).

    Texts without such lines are unchanged, null texts stay null with no lines, and an empty text is one line. A text
    all of whose lines go is empty. Rows that repeat key and text are one document and have the same result each; other
    columns pass unchanged.
    """
    rows = docs.drop("n_lines", "n_dropped")
    own = "_" * max(map(len, rows.columns))
    drops = duplicates(docs, key, text, least_words, near_words).distinct()
    drops = stored(drops.groupBy("id", "doc").agg(F.collect_list("n").alias("ns")), "lines-drops")
    id_, doc, gone = f"{own}id", f"{own}doc", f"{own}gone"
    rows = rows.withColumn(doc, F.xxhash64(F.lit(0), key, text))
    keep = keeper(drops, "doc")
    # Only documents that may lose a line are shuffled.
    touched = keep(rows, F.col(doc)).join(
        drops.select(F.col("id").alias(id_), F.col("doc").alias(f"{doc}2"), F.col("ns").alias(gone)),
        (F.col(doc) == F.col(f"{doc}2")) & F.col(key).eqNullSafe(F.col(id_)),
        "left",
    )
    parts = F.split(F.col(text), "\n")
    kept = F.filter(parts, lambda x, i: ~F.array_contains(F.col(gone), i))
    counted = F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long")
    names = [c for c in rows.columns if c != doc]
    whole = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    changed = touched.select(*[F.col(f"`{c}`") for c in names if c != text], whole.alias(text), counted.alias("n_lines"), F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"))
    rest = keep(rows, F.col(doc), False).select(*names, counted.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    return changed.unionByName(rest).select(*names, "n_lines", "n_dropped")
