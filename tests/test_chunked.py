"""The two-level scans must equal plain windows, whatever the chunk width and however hot a key is."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millstream.operators import chunked, temporal


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        minute = rng.randrange(0, 3000)
        value = None if rng.random() < 0.4 else float(rng.randrange(100))
        rows.append((key, i, minute, value))
    df = spark.createDataFrame(rows, "k string, id int, m int, v double")
    ts = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"))
    return df.withColumn("ts", ts).cache()


@pytest.mark.parametrize("width", ["30 minutes", "7 days"])
def test_scans_equal_windows(frame, width):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = frame.select(
        "id",
        F.lag("v").over(w).alias("prev"),
        F.lead("id").over(w).alias("next"),
        F.row_number().over(w).cast("long").alias("rn"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ff"),
        F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("bf"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("strict"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"),
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)).alias("run"),
    )
    order = ["ts", "id"]
    df = chunked.with_time_chunk(frame, "ts", width)
    # Each scan reads its input twice, so the scans run one by one and not as a chain.
    scans = {
        "prev": chunked.previous(df, "k", order, ["v"], "x").withColumn("x", F.col("x.v")),
        "next": chunked.following(df, "k", order, ["id"], "x").withColumn("x", F.col("x.id")),
        "rn": chunked.numbered(df, "k", order, "x"),
        "ff": chunked.fill(df.withColumn("x", F.col("v")), "k", order, ["x"]),
        "bf": chunked.fill(df.withColumn("x", F.col("v")), "k", order, ["x"], backward=True),
        "strict": chunked.fill(df.withColumn("x", F.col("v")), "k", order, ["x"], strict=True),
        "mx": chunked.running_max(df, "k", order, "v", "x"),
        "run": chunked.running_sum(df, "k", order, {"x": F.col("v")}),
    }
    want = plain.collect()
    for name, scan in scans.items():
        got = {r["id"]: r["x"] for r in scan.select("id", "x").collect()}
        assert got == {r["id"]: r[name] for r in want}, name


def test_blocks_hold_complete_frames(spark):
    df = spark.range(1, 101).select(F.lit("k").alias("k"), F.col("id").alias("rn"))
    blocks = chunked.in_blocks(df, "rn", before=3, after=2, rows=10)
    w = Window.partitionBy("k", chunked.CHUNK).orderBy("rn").rowsBetween(-3, 2)
    got = blocks.withColumn("n", F.count("*").over(w)).withColumn("s", F.sum("rn").over(w)).filter("__own")
    rows = {r["rn"]: (r["n"], r["s"]) for r in got.collect()}
    for i in range(1, 101):
        inside = [j for j in range(i - 3, i + 3) if 1 <= j <= 100]
        assert rows[i] == (len(inside), sum(inside))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("forward", [True, False])
def test_asof_equals_brute_force(spark, strict, forward):
    rng = random.Random(3)
    left = [(rng.choice("ab"), i, rng.randrange(200)) for i in range(80)] + [(None, 90, 5), ("a", 91, None)]
    right = [(rng.choice("ab"), rng.randrange(200), i) for i in range(60)] + [(None, 4, 99), ("a", None, 98)]
    origin = F.lit("2024-01-01").cast("timestamp_ntz")
    lf = spark.createDataFrame(left, "k string, id int, m int").withColumn(
        "ts", origin + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"))
    )
    rf = spark.createDataFrame(right, "k string, rm int, tag int").withColumn(
        "rts", origin + F.make_dt_interval(F.lit(0), F.lit(0), F.col("rm"))
    )
    got = temporal.asof_join(lf, rf, "k", "ts", "rts", ["rm", "tag"], "hit", strict=strict, forward=forward,
                             tiebreak=["tag"], width="30 minutes")
    found = {r["id"]: (r["hit"] and (r["hit"]["rm"], r["hit"]["tag"])) for r in got.collect()}
    assert len(found) == len(left)
    for k, i, m in left:
        fits = []
        if k is not None and m is not None:
            for rk, rm, tag in right:
                if rk != k or rm is None:
                    continue
                distance = rm - m if forward else m - rm
                if distance > 0 or (distance == 0 and not strict):
                    fits.append((distance, tag, rm))
        best = min(fits) if fits else None
        assert found[i] == (best and (best[2], best[1]))


def test_interval_first_equals_brute_force(spark):
    rng = random.Random(11)
    origin = F.lit("2024-01-01").cast("timestamp_ntz")

    def minutes(c):
        return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.col(c))

    spans = []
    for i in range(70):
        start = rng.randrange(300)
        spans.append((rng.choice("ab"), i, start, start + rng.choice([0, 5, 40, 200])))
    events = [(rng.choice("abc"), i, rng.randrange(400)) for i in range(150)]
    sf = spark.createDataFrame(spans, "k string, sid int, s int, f int").withColumns({"st": minutes("s"), "fi": minutes("f")})
    ef = spark.createDataFrame(events, "k string, id int, m int").withColumn("ts", minutes("m"))
    got = temporal.interval_join_first(ef, sf, "k", "ts", "st", "fi", ["sid"], ["sid"], width="20 minutes")
    found = {r["id"]: r["match"] and r["match"]["sid"] for r in got.collect()}
    for k, i, m in events:
        fits = sorted((s, f, sid) for sk, sid, s, f in spans if sk == k and s <= m <= f)
        assert found[i] == (fits[0][2] if fits else None)


def test_gap_of_exactly_the_threshold_splits(spark, at):
    rows = [("m", at(0)), ("m", at(9.99)), ("m", at(19.99)), ("m", at(200)), ("one", at(5))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = temporal.gap_segments(df, "k", "ts", "10 minutes", width="15 minutes")
    assert {(r["k"], r["ts"]): r["segment"] for r in got.collect()} == dict(zip(rows, [0, 0, 1, 2, 0]))


def test_asof_join_spreads_rows_without_time(spark, at):
    """Rows without time keep no match, and lie in many chunks instead of one."""
    left = [("k", None, i) for i in range(400)] + [("k", at(5), 1000), (None, at(5), 1001), (None, None, 1002)]
    left = spark.createDataFrame(left, "k string, t timestamp_ntz, i int")
    right = spark.createDataFrame([("k", at(1), "a"), ("k", at(9), "b"), ("k", None, "c")], "k string, t timestamp_ntz, v string")
    for forward, want in ((False, "a"), (True, "b")):
        got = temporal.asof_join(left, right, "k", "t", "t", ["v"], "m", forward=forward).collect()
        assert len(got) == 403 and {r["i"]: r["m"]["v"] for r in got if r["m"] is not None} == {1000: want}
