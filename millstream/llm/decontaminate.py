"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of measure are replaced by typed placeholders, so that a question and a re-parameterised copy of
it have one template. Windows of the templates of texts and benchmark items are joined by hash. What stands in the
placeholders must then agree: along one alignment of a text and an item, a window counts if its values are the item's, or
those that usually stand for them in this alignment, so that a copy is the question with its values exchanged throughout,
and not another text of like form. A value out of step costs its own windows only.

A bit table of the items' windows, of fixed size, tells within a row which windows of a text are worth joining, so that
texts are never shuffled, and only rows near the benchmark are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.llm.sieve import keeper, sieve
from millstream.session import stored

#: Tokens of a window, of which so many must be plain words; shorter items are one window, with as many plain words less.
WINDOW, WORDS = 6, 4
LEAST_TOKENS = 4
#: Share of an item's windows that must be in a text.
SHARE = 0.4
#: Adjoining tokens of an item that are a passage of it, however long the item is.
RUN = 13
#: Units of measure, told as such after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres kilometer kilometers "
    "g kg mg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons s ms sec min h hr hrs second seconds "
    "minute minutes hour hours day days week weeks month months year years l ml liter liters litre litres gallon gallons "
    "percent dollar dollars euro euros cent cents degree degrees kmh mph watt watts volt volts"
).split()
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+(?:['’-]\p{L}+)*[.!?]?"
NUMBER, NAME, UNIT = "#num", "#name", "#unit"


def tokens(text: Column) -> Column:
    """Numbers and words in order; a word that ends a sentence keeps its mark."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def template(found: str) -> Column:
    """Tokens in lower case without marks, with placeholders: a word is a name if it is written as one within a sentence."""

    def one(x: Column, i: Column) -> Column:
        before = F.get(found, i - 1)
        first = F.substring(x, 1, 1)
        low = F.rtrim(F.lower(x), F.lit(".!?"))
        ended = F.coalesce(F.substring(before, -1, 1).isin(".", "!", "?"), F.lit(True))
        rest = F.substring(x, 2, 2**30)
        return (
            F.when(first.between("0", "9"), NUMBER)
            .when(F.substring(before, 1, 1).between("0", "9") & low.isin(UNITS), UNIT)
            .when(x == F.lower(x), low)
            .when(~ended & (first != F.lower(first)) & (rest == F.lower(rest)) & (F.length(x) > 1), NAME)
            .otherwise(low)
        )

    return F.transform(found, one)


def items(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, n, total, at, h, c, v): eligible windows of the items, each with its item's number of them.

    Items with fewer than LEAST_TOKENS tokens, null texts and windows with too few plain words have none. Rows that
    repeat an item's id are told apart by text, and equal rows are one; an item without id is one too.
    """
    rows = benchmark.select(F.col(key).alias("item"), tokens(F.col(text)).alias("w")).distinct().withColumn("c", template("w"))
    rows = rows.withColumn("v", F.transform("w", lambda x: F.rtrim(F.lower(x), F.lit(".!?")))).filter(F.size("c") >= LEAST_TOKENS)
    rows = rows.withColumn("n", F.least(F.size("c"), F.lit(WINDOW))).withColumn("text", F.xxhash64("w"))
    windows = F.transform(
        F.sequence(F.lit(1), F.size("c") - F.col("n") + 1),
        lambda i: F.struct(i.alias("at"), F.slice("c", i, F.col("n")).alias("c"), F.slice("v", i, F.col("n")).alias("v")),
    )
    each = rows.select("item", "text", "n", F.explode_outer(windows).alias("s")).select("item", "text", "n", "s.*")
    plain_words = F.size(F.filter("c", lambda x: ~F.startswith(x, F.lit("#"))))
    each = each.filter(plain_words >= F.greatest(F.col("n") - (WINDOW - WORDS), F.lit(1))).withColumn("h", F.xxhash64("c"))
    return each.withColumn("total", F.count("*").over(Window.partitionBy("item", "text")))  # the windows of one item


def _values(found: Column) -> Column:
    """Tokens in lower case without marks."""
    return F.transform(found, lambda x: F.rtrim(F.lower(x), F.lit(".!?")))


def _copies(docs: DataFrame, benchmark: DataFrame, parts: DataFrame, key: str, text: str, item_key: str, item_text: str) -> DataFrame:
    """(id, doc, item): texts with an exact copy, up to case, of an item without eligible window.

    Items of fewer than LEAST_TOKENS tokens must be a line of their own, as within a sentence anyone may use these words.
    """
    rows = benchmark.select(F.col(item_key).alias("item"), tokens(F.col(item_text)).alias("w")).filter(F.size("w") > 0).withColumn("text", F.xxhash64("w"))
    rows = rows.join(parts.select("text").distinct(), "text", "left_anti").select("item", _values(F.col("w")).alias("v")).distinct()
    rows = rows.withColumns({"n": F.least(F.size("v"), F.lit(WINDOW)), "lone": F.size("v") < LEAST_TOKENS})
    whole = stored(rows.withColumn("h", F.xxhash64(F.slice("v", F.lit(1), F.col("n")))), "benchmark-whole")
    kinds = whole.groupBy("lone", "n").agg(F.max(F.size("v")).alias("most")).collect()  # no more than WINDOW rows
    own = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("doc"), F.col(text).alias("t"))
    made = own.limit(0).select("id", "doc").crossJoin(whole.limit(0).select("item"))
    if any(not k.lone for k in kinds):
        sizes, most = sorted(k.n for k in kinds if not k.lone), max(k.most for k in kinds if not k.lone)
        some = whole.filter("NOT lone")
        may = sieve(some, "h")

        def window(n: int, i: Column) -> Column:
            return F.struct(F.xxhash64(F.slice("c", i, F.lit(n))).alias("h"), F.slice("c", i, F.lit(most)).alias("u"))

        cut = F.flatten(F.array(*[_places(n, may, window) for n in sizes]))  # before the explode, as in `leaks`
        near = own.select("id", "doc", _values(tokens(F.col("t"))).alias("c")).select("id", "doc", F.explode_outer(cut).alias("s"))
        near = near.filter("s IS NOT NULL").select("id", "doc", "s.*")
        held = near.join(some, "h").filter(F.slice("u", F.lit(1), F.size("v")) == F.col("v"))
        made = made.unionByName(held.select("id", "doc", "item"))
    if any(k.lone for k in kinds):
        some = whole.filter("lone")
        may = sieve(some, "h")
        each = F.array_distinct(F.transform(F.split("t", "\n"), lambda x: _values(tokens(x))))
        near = own.select("id", "doc", F.explode_outer(F.filter(each, lambda u: may(F.xxhash64(u)))).alias("u")).filter("u IS NOT NULL")
        held = near.withColumn("h", F.xxhash64("u")).join(some, "h").filter(F.col("u") == F.col("v"))
        made = made.unionByName(held.select("id", "doc", "item"))
    return made.distinct()


def _longest_run(ats: Column, n: Column) -> Column:
    """Most adjoining tokens that windows of n tokens cover. ats: their distinct places."""

    def step(x: Column, at: Column) -> Column:
        start = F.when(at <= x["to"] + 1, x["start"]).otherwise(at)
        return F.struct(start.alias("start"), (at + n - 1).alias("to"), F.greatest(x["most"], at + n - start).alias("most"))

    none = F.struct(F.lit(0).alias("start"), F.lit(-1).alias("to"), F.lit(0).alias("most"))
    return F.aggregate(F.array_sort(ats), none, step, lambda x: x["most"])


def _agreeing(met: DataFrame, one: list[str]) -> DataFrame:
    """(one, total, n, ats, changed): windows of each alignment that are verbatim, or whose values are the usual ones.

    The usual value is the one that most places of the alignment with this value of the item have, verbatim ones first.
    Values that differ in the item may have become equal.
    """
    met = met.distinct()  # rows that repeat id and text are one
    slots = F.filter("z", lambda x: F.startswith(x["c"], F.lit("#")))
    placed = met.select(*one, "at", F.posexplode("z").alias("k", "s")).filter(F.startswith("s.c", F.lit("#")))
    slot = F.concat_ws(" ", "s.c", "s.v").alias("slot")
    placed = placed.select(*one, (F.col("at") + F.col("k")).alias("place"), slot, F.col("s.u").alias("u"), (F.col("s.v") == F.col("s.u")).alias("same")).distinct()
    counts = placed.groupBy(*one, "slot", "u", "same").agg(F.count("*").alias("times"))
    usual = counts.groupBy(*one, "slot").agg(F.max(F.struct("times", "same", "u")).alias("m"))
    usual = usual.groupBy(*one).agg(F.map_from_entries(F.collect_list(F.struct("slot", "m.u"))).alias("usual"))
    joined = met.alias("l").join(usual.alias("b"), [F.col(f"l.{c}").eqNullSafe(F.col(f"b.{c}")) for c in one], "left").select("l.*", "b.usual")
    verbatim = F.forall(slots, lambda x: x["v"] == x["u"])
    as_usual = F.forall(slots, lambda x: F.element_at("usual", F.concat_ws(" ", x["c"], x["v"])) == x["u"])
    differ = F.filter(slots, lambda x: x["v"] != x["u"])
    good = joined.filter(verbatim | as_usual)
    return good.groupBy(*one, "total", "n").agg(F.collect_set("at").alias("ats"), F.size(F.array_distinct(F.flatten(F.collect_list(differ)))).alias("changed"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", share: float = SHARE, run: int = RUN
) -> DataFrame:
    """(key, doc, item, windows, share, changed): each text with each item that it holds.

    A text holds an item if it has `share` of its windows, or `run` adjoining tokens of it along one alignment, however long
    the item is, or an exact copy of an item without eligible window (see `_copies`), which counts as one window. The
    windows of an alignment are judged each (see `_agreeing`).

    doc: a hash of key and text, which rows that repeat both have in common; they are one. windows: of the item, found in
    alignments whose values agree; changed: placeholders whose value differs. Null and empty texts hold nothing, and
    neither does a null id keep a text from being found.
    """
    parts = stored(items(benchmark, item_key, item_text), "benchmark-windows")
    sizes = sorted(r.n for r in parts.select("n").distinct().collect())  # no more than WINDOW values
    may = sieve(parts, "h")
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("doc"), tokens(F.col(text)).alias("w")).withColumn("c", template("w"))
    kind = "array<struct<place:int,c:array<string>,u:array<string>>>"

    def window(n: int, i: Column) -> Column:
        return F.struct(i.alias("place"), F.slice("c", i, F.lit(n)).alias("c"), _values(F.slice("w", i, F.lit(n))).alias("u"))

    # Windows are cut out before the explode, since Spark holds all rows that it makes of a text at once: with the whole
    # text on each, they would grow with its length times its windows. An outer explode: for a plain one Spark would test
    # the list's size first, and make it anew for that.
    cut = F.flatten(F.array(*[_places(n, may, window) for n in sizes])) if sizes else F.array().cast(kind)
    near = rows.select("id", "doc", F.explode_outer(cut).alias("s")).filter("s IS NOT NULL").select("id", "doc", "s.*")
    near = stored(near.withColumn("h", F.xxhash64("c")), "benchmark-near")
    met = near.join(parts, ["h", "c"]).withColumn("line", F.col("place") - F.col("at"))
    one = ["id", "doc", "item", "text", "line"]
    met = stored(met.select(*one, "total", "n", "at", F.arrays_zip("c", "v", "u").alias("z")), "benchmark-met")
    good = _agreeing(met, one)
    found = good.groupBy("id", "doc", "item", "text", "total").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("windows"), F.max("changed").alias("changed"), F.max(_longest_run(F.col("ats"), F.col("n"))).alias("run")
    )
    found = found.withColumn("share", F.col("windows") / F.col("total"))
    found = found.filter((F.col("share") >= share) | (F.col("run") >= run)).select("id", "doc", "item", "share", "windows", "changed")
    copies = _copies(docs, benchmark, parts, key, text, item_key, item_text)
    found = found.unionByName(copies.select("*", F.lit(1.0).alias("share"), F.lit(1).alias("windows"), F.lit(0).alias("changed")))
    best = found.groupBy("id", "doc", "item").agg(F.max(F.struct("share", "windows", "changed")).alias("m"))
    return best.select(F.col("id").alias(key), "doc", F.col("item").alias(item_key), F.col("m.windows").cast("long").alias("windows"), "m.share", "m.changed")


def _places(n: int, may, window: Callable[[int, Column], Column]) -> Column:
    """`window` of n and of the place of each window of n tokens that may be in the benchmark."""
    every = F.when(F.size("c") >= n, F.sequence(F.lit(1), F.size("c") - (n - 1))).otherwise(F.array().cast("array<int>"))
    kept = F.filter(every, lambda i: may(F.xxhash64(F.slice("c", i, F.lit(n)))))
    return F.transform(kept, lambda i: window(n, i))


def clean(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item. found: as `leaks` gives it. Rows without key or text stay."""
    own = "_" * max(map(len, docs.columns)) + "doc"
    rows = docs.withColumn(own, F.xxhash64(key, text))
    keep = keeper(found, "doc")
    hit = found.select(F.col("doc").alias(own), F.col(key).alias(f"{own}id")).distinct()
    near = keep(rows, F.col(own))
    kept = near.join(hit, (near[own] == hit[own]) & near[key].eqNullSafe(hit[f"{own}id"]), "left_anti")
    return kept.unionByName(keep(rows, F.col(own), False)).drop(own)
