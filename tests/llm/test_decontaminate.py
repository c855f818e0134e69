"""Items are found with other numbers, names and units, and texts of like form are not."""

import re

from millstream.llm import decontaminate

ITEM = "A train leaves the old station at 40 km and then Anna walks 12 km more before she meets Paul at the gate."
OTHER = "The answer of this short question is known to nobody who reads the book in a quiet garden."
DOCS = "doc_id long, text string, item_id string, c int"


def found(spark, docs, items=((1, ITEM), (2, OTHER))):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS)
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.changed for r in decontaminate.leaks(df, bench).collect()}


def test_found_with_other_values(spark):
    changed = ITEM.replace("40 km", "75 miles").replace("12 km", "30 miles").replace("Anna", "Maria").replace("Paul", "Igor")
    docs = [(1, f"Some words before. {ITEM} And after."), (2, changed.lower().replace("maria", "Maria").replace("igor", "Igor")), (3, f"{OTHER.upper()}"), (4, "nothing of the kind at all in here")]
    got = found(spark, docs)
    assert set(got) == {(1, 1), (2, 1), (3, 2)} and got[1, 1] == 0 and got[2, 1] >= 4


def test_values_must_agree(spark):
    """Values that are neither the item's nor the usual ones for it cost their windows; few windows are no copy."""
    item = "first we add 5 apples to the box and later we add 5 pears to the same box again today"
    docs = [(1, item.replace("5", "9")), (2, item.replace("5 apples", "7 apples")), (3, "first we add 7 apples to the pot and stir")]
    got = found(spark, docs, [(1, item)])
    assert (1, 1) in got and (2, 1) in got and (3, 1) not in got


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "two words"), (4, "one two three four"), (None, "an item that has no id but words"), (4, "one two three four"), (5, "1 2 3 4 5 6 7 8")]
    docs = [(1, None), (2, ""), (3, "one two three four"), (3, "one two three four"), (None, "here is one two three four"), (6, "an item that has no id but words"), (7, "1 2 3 4 5 6 7 8"), (8, "word " * 30_000 + "one two three four")]
    got = found(spark, docs, items)
    assert set(got) == {(3, 4), (None, 4), (6, None), (7, 5), (8, 4)}
    assert found(spark, docs, []) == {} and found(spark, [], items) == {}


def passages(spark, docs, items):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS)
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, run=decontaminate.RUN).collect()}


def test_passages_and_items_without_windows(spark):
    """A passage of a long item is found whatever its share, and so is a copy of an item without plain words enough."""
    long = " ".join(f"{a}{b}" for a in ("ka", "mo", "ri", "tu", "ve", "so", "ni", "pa", "lo", "de") for b in ("bel", "dor", "fin", "gar", "hol", "jup"))
    words = long.split()
    items = [(1, long), (2, "1 2 3 4 5 6 7 8"), (3, "two words")]
    docs = [
        (1, "before " + " ".join(words[10:30]) + " after"), (2, "before " + " ".join(words[10:22]) + " after"), (3, "sum of 1 2 3 4 5 6 7 8 here"),
        (4, "1 2 3 4 5 6 7 9"), (5, "a line\nTwo words.\nmore"), (6, "these two words are common"), (None, "1, 2, 3, 4, 5, 6, 7, 8"), (7, None),
    ]
    assert passages(spark, docs, items) == {(1, 1), (3, 2), (None, 2), (5, 3)}
    assert passages(spark, docs, []) == set()


def test_windows_are_judged_each(spark):
    """One value that disagrees costs its own windows only, and values may become equal."""
    item = "first we add 5 apples to the box and later we add 5 pears to the same box again today"
    docs = [
        (1, item.replace("5 apples", "7 apples")), (2, item.replace("5 apples", "7 apples").replace("5 pears", "9 pears")), (3, ITEM.replace("40", "30").replace("12", "30")),
        (3, ITEM.replace("40", "30").replace("12", "30")), (4, "first we add 7 apples to the pot and stir"), (None, item.replace("5", "8")),
    ]
    assert passages(spark, docs, [(1, item), (2, ITEM)]) == {(1, 1), (2, 1), (3, 2), (None, 1)}


def test_clean_keeps_the_others(spark):
    df = spark.createDataFrame([(1, ITEM, "x", 1), (2, "clean text", "x", 2), (None, None, "x", 3), (None, ITEM, "x", 4), (2, ITEM, "x", 5)], DOCS)
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontaminate.clean(df, decontaminate.leaks(df, bench))
    assert kept.columns == df.columns and sorted(r.c for r in kept.collect()) == [2, 3]


def test_windows_do_not_carry_their_text(spark, monkeypatch):
    """All windows of a text are held at once, so that one dense text would take its length times its windows."""
    kept = {}
    plain = decontaminate.stored

    def stored(df, label):
        kept[label] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(decontaminate, "stored", stored)
    dense = " ".join(f"{ITEM} {OTHER} now five words make it" for _ in range(40))
    docs = spark.createDataFrame([(1, dense), (2, "nothing of the kind")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, OTHER), (3, "5 6 7 8 9 10")], "item_id long, text string")
    made = decontaminate.leaks(docs, items)
    plans = kept["benchmark-near"] + made._jdf.queryExecution().executedPlan().toString()
    beside = [re.findall(r"(\w+)#", x) for x in re.findall(r"Generate explode\(.*\), \[([^\]]*)\], true", plans)]
    assert len(beside) == 2 and all(x == ["id", "doc"] for x in beside)
    assert {r.item_id for r in made.collect()} == {1, 2}
