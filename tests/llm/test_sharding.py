"""Every shard fits its limit, every row has one shard, and only large buckets are split."""

import hashlib

from pyspark.sql import functions as F

from millstream.llm import sharding

SCHEMA = "doc_id long, text string, shard string, h1 int"


def brute(rows, limit):
    """Splits a bucket on the next bit of MD5 until it fits."""

    def bits(doc_id, text):
        half = lambda x: bin(int(hashlib.md5(x.encode()).hexdigest()[:15], 16))[2:].zfill(60)
        return half("" if doc_id is None else str(doc_id)) + half(text or "")

    out, todo = {}, [("", [(bits(r[0], r[1]), r) for r in rows])]
    while todo:
        name, held = todo.pop()
        if not held:
            continue
        if sum(len((r[1] or "").encode()) for _, r in held) <= limit or len(held) == 1:
            for _, r in held:
                out[r[0], r[1]] = name
        else:
            todo += [(name + b, [(a, r) for a, r in held if a[len(name)] == b]) for b in "01"]
    return out


def test_equals_splitting_one_by_one(spark):
    rows = [(i, "é" * (i % 37), "mine", 3) for i in range(400)] + [(None, "no id", "mine", 3), (1000, None, "mine", 3), (1001, "x" * 5000, "mine", 3)]
    expected = brute(rows, 600)
    made = sharding.assign(spark.createDataFrame(rows, SCHEMA), 600)
    assert made.columns == ["doc_id", "text", "h1", "shard", "shard_rows", "shard_bytes"]
    got = made.collect()
    assert len(got) == len(rows) and {(r.doc_id, r.text): r.shard for r in got} == expected
    for r in got:
        same = [x for x in got if x.shard == r.shard]
        assert r.shard_rows == len(same) and r.shard_bytes == sum(len((x.text or "").encode()) for x in same)


def test_one_key_with_many_texts_and_copies(spark):
    rows = [(7, f"text {i:04d}", "", 0) for i in range(200)] + [(8, "same text!", "", 0)] * 90
    got = sharding.assign(spark.createDataFrame(rows, SCHEMA).repartition(4), 100).collect()
    assert len(got) == len(rows) and max(r.shard_bytes for r in got) <= 100
    for name, size in {r.shard: r.shard_rows for r in got}.items():
        assert size == sum(r.shard == name for r in got)


def test_all_in_one_and_none(spark):
    df = spark.createDataFrame([(1, "a", "", 0), (1, "a", "", 0)], SCHEMA)
    assert [(r.shard, r.shard_rows) for r in sharding.assign(df, 10).collect()] == [("", 2)] * 2
    assert sharding.assign(df.limit(0), 10).count() == 0


def test_written_files_hold_the_shards(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), 10).alias("text"))
    sharding.write(docs, str(tmp_path / "out"), 1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 300 and back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).filter("b > 1000").count() == 0
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "out").glob("shard=*"))
