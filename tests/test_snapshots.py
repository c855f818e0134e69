"""Versions of a table replace each other in one step, and only touched partitions are read and written."""

import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millstream.session import shared_path
from millstream.sources import snapshots

SCHEMA = "k long, v long, p string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((r.k, r.v, r.p) for r in df.select("k", "v", "p").collect())


@pytest.mark.parametrize("by", [(), ("p",)])
def test_upserts_equal_a_dictionary(spark, by):
    rng = random.Random(len(by))
    path, held = shared_path(spark, "snapshot"), {}
    for _ in range(4):
        new = [(rng.randint(0, 30), rng.randint(0, 99), None) for _ in range(12)]
        new = [(k, v, ["0001", "b c", None][k % 3]) for k, v, _ in new]
        snapshots.upsert(spark, path, frame(spark, new), ["k", "p"], [F.col("v").desc()], by)
        best = {}
        for k, v, p in new:
            best[k, p] = max(v, best.get((k, p), -1))
        held |= best
        expected = sorted(((k, v, p) for (k, p), v in held.items()), key=str)
        assert sorted(((r.k, r.v, r.p) for r in snapshots.read(spark, path).collect()), key=str) == expected


@pytest.mark.parametrize("when", ["rows", "list"])
@pytest.mark.parametrize("by", [(), ("p",)])
def test_a_killed_write_leaves_the_old_table(spark, monkeypatch, by, when):
    path = shared_path(spark, "snapshot")
    first = [(1, 1, "a"), (2, 2, "b")]
    snapshots.replace(spark, path, frame(spark, first), by)
    new = frame(spark, [(1, 10, "a"), (3, 30, "a")])
    if when == "rows":
        # A task fails while the rows are written.
        broken = new.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("v")))
        monkeypatch.setattr(snapshots, "stored", lambda df, label: df)
        with pytest.raises(Exception, match="killed"):
            snapshots.upsert(spark, path, broken, ["k", "p"], [F.col("v")], by)
    else:
        # The rows are written, and the list is not.
        def killed(value):
            raise OSError("killed")

        monkeypatch.setattr(snapshots, "json", SimpleNamespace(dumps=killed, loads=json.loads))
        with pytest.raises(OSError, match="killed"):
            snapshots.upsert(spark, path, new, ["k", "p"], [F.col("v")], by)
        monkeypatch.undo()
    assert rows_of(snapshots.read(spark, path)) == first
    monkeypatch.undo()
    snapshots.upsert(spark, path, new, ["k", "p"], [F.col("v")], by)
    assert rows_of(snapshots.read(spark, path)) == [(1, 10, "a"), (2, 2, "b"), (3, 30, "a")]
    assert rows_of(snapshots.read(spark, path, 1)) == first


def test_untouched_partitions_are_not_read_nor_written(spark):
    path = shared_path(spark, "snapshot")
    snapshots.replace(spark, path, frame(spark, [(i, i, f"p{i % 50}") for i in range(500)]), ["p"])
    within = frame(spark, [(1, 1, "p7"), (2, 2, "p9")])
    asked = snapshots.read(spark, path, within=within)
    assert {f.split("p=")[1].split("/")[0] for f in asked.inputFiles()} >= {"p7", "p9"} and asked.count() == 20
    scan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "p7" in scan.split("PartitionFilters")[1]
    snapshots.upsert(spark, path, frame(spark, [(7, 70, "p7")]), ["k", "p"], [F.col("v")], ["p"])
    places = snapshots._list(spark, path, 2)[0].groupBy("folder").count().collect()
    assert sorted(r["count"] for r in places) == [1, 49]


def test_no_table_and_other_partitions(spark):
    path = shared_path(spark, "snapshot")
    with pytest.raises(ValueError, match="no table"):
        snapshots.read(spark, path)
    snapshots.replace(spark, path, frame(spark, []), ["p"])
    assert snapshots.read(spark, path).collect() == []
    with pytest.raises(ValueError, match="partitioned by"):
        snapshots.upsert(spark, path, frame(spark, [(1, 1, "a")]), ["k"], [F.col("v")])
