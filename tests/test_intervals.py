"""Joins of points and spans of any length, and production between work orders, against nested loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millstream.operators import chunked, joins, temporal

T0 = dt.datetime(2024, 1, 1)
FAR = dt.datetime(9999, 12, 31, 23, 59, 59)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def some(seed, points=120, spans=40):
    rng = random.Random(seed)
    p = [(rng.choice(["a", "a", "b", None]), i, at(rng.randint(-500, 3000))) for i in range(points)] + [("a", points, None)]
    s = []
    for i in range(spans):
        start = rng.randint(-600, 3000)
        s.append((rng.choice(["a", "b", "c", None]), i, at(start), rng.choice([FAR, at(start), at(start + rng.randint(1, 9)), at(start + rng.randint(1, 4000)), at(start - 5), None])))
    return p, s


INSIDE = {"both": lambda t, a, b: a <= t <= b, "left": lambda t, a, b: a <= t < b, "neither": lambda t, a, b: a < t < b}


@pytest.mark.parametrize("closed", INSIDE)
@pytest.mark.parametrize("bucket", ["1 minute", "10 minutes", "1 day"])
def test_tree_pairs_equal_a_nested_loop(spark, closed, bucket):
    points, spans = some(len(bucket))
    p = spark.createDataFrame(points, "k string, id long, t timestamp_ntz")
    s = spark.createDataFrame(spans, "k string, span long, st timestamp_ntz, fi timestamp_ntz")
    found = sorted((r.span, r.id) for r in temporal.tree_pairs(p, s, "k", "t", "st", "fi", bucket, closed).collect())
    inside = INSIDE[closed]
    assert found == sorted((i, j) for k, i, a, b in spans for q, j, t in points if k is not None and k == q and t is not None and b is not None and a <= b and inside(t, a, b))


def test_an_open_span_makes_few_rows(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:03:00' as st, timestamp_ntz'9999-12-31 23:59:59' as fi")
    for bucket in ("1 second", "10 minutes", "8 hours"):
        n = df.select(F.size(temporal._nodes(temporal.bucket_no("st", bucket), temporal.bucket_no("fi", bucket)))).first()[0]
        assert n < 100


def test_nodes_are_disjoint_and_cover_the_span(spark):
    cases = [(a, b) for a in (-70, -1, 0, 3, 17) for b in (-65, 0, 3, 4, 16, 300) if a <= b]
    rows = spark.createDataFrame(cases, "a long, b long").select("a", "b", temporal._nodes(F.col("a"), F.col("b")).alias("n")).collect()
    for r in rows:
        assert sorted(x for n in r.n for x in range(n.node << 2 * n.level, (n.node + 1) << 2 * n.level)) == list(range(r.a, r.b + 1))


def test_work_order_periods_equal_a_nested_loop(spark):
    rng = random.Random(3)
    day = lambda: rng.choice([None, *[dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 900)) for _ in range(12)]])
    made = [(rng.choice(["x", "y", None]), day(), rng.choice([None, 1, 5, 7])) for _ in range(150)]
    orders = [(rng.choice(["x", "y", "z", None]), day(), day()) for _ in range(60)]
    orders += orders[:5]
    o = spark.createDataFrame(orders, "k string, prev date, cur date")
    m = spark.createDataFrame(made, "k string, d date, q long")
    found = sorted((tuple(r) for r in joins.wo_period_join(o, m, "k", "prev", "cur", "d", "q").collect()), key=str)
    expected = []
    for order in set(orders):
        k, prev, cur = order
        own = [(d, q or 0) for key, d, q in made if key == k and d is not None]
        times = orders.count(order)
        between = sum(q for d, q in own if prev <= d <= cur) if prev and cur else 0
        expected.append((*order, times * between, times * sum(q for d, q in own if cur and d > cur)))
    assert found == sorted(expected, key=str)


def test_work_order_periods_have_no_calendar(spark):
    """Two days a thousand years apart are two rows of the running totals, not one for each day."""
    m = spark.createDataFrame([("x", dt.date(1024, 1, 1), 1), ("x", dt.date(2024, 1, 1), 2)], "k string, d date, q long")
    o = spark.createDataFrame([("x", dt.date(1000, 1, 1), dt.date(2023, 1, 1))], "k string, prev date, cur date")
    made = joins.wo_period_join(o, m, "k", "prev", "cur", "d", "q")
    assert made.first()[3:] == (1, 2) and "sequence" not in made._jdf.queryExecution().executedPlan().toString()


def dated(spark, facts, versions):
    f = spark.createDataFrame(facts, "k string, id long, t timestamp_ntz")
    v = spark.createDataFrame(versions, "k string, version long, st timestamp_ntz, fi timestamp_ntz")
    return joins.effective_dated_join(f, v, "k", "t", "st", "fi")


def test_versions_in_force_equal_a_nested_loop(spark):
    facts, versions = some(8, 150, 40)
    rng = random.Random(8)
    versions = [(k, i, rng.choice([None, a, a]), b) for k, i, a, b in versions] + [("a", 900, None, None), (None, 901, None, None)]
    facts += [("a", 500 + i, v) for i, (_, _, a, b) in enumerate(versions) for v in (a, b)]
    got = dated(spark, facts, versions)
    assert got.columns == ["k", "id", "t", "version", "st", "fi"]
    expected = [(j, i) for k, i, a, b in versions for q, j, t in facts if k is not None and k == q and (a is None or t is not None and a <= t) and (b is None or t is not None and b >= t)]
    assert sorted((r.id, r.version) for r in got.collect()) == sorted(expected)


def test_many_versions_of_one_key(spark):
    """Ten thousand versions, one after the other: each fact meets its own."""
    versions = [("a", i, at(i * 10), T0 + dt.timedelta(minutes=i * 10 + 10, microseconds=-1)) for i in range(10_000)]
    facts = [("a", i, at(i * 500 + 3)) for i in range(200)] + [("a", 999, at(-1))]
    assert sorted((r.id, r.version) for r in dated(spark, facts, versions).collect()) == [(i, i * 50) for i in range(200)]


def test_short_spans_take_few_levels_of_the_tree(spark):
    """A step of the walk for each level is the cost of a span; a short one must not pay for the longest."""
    rows = spark.createDataFrame([(5, 5), (5, 6), (-3, 2)], "a long, b long").select(temporal._nodes(F.col("a"), F.col("b")).alias("n"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert f"sequence(0, {temporal._TOP_LEVEL}," not in plan.lower()
    assert [[tuple(x) for x in r.n] for r in rows.collect()] == [[(0, 5)], [(0, 5), (0, 6)], [(0, -3), (0, -2), (0, -1), (0, 0), (0, 1), (0, 2)]]


def test_the_shift_map_is_made_in_many_tasks(spark, tmp_path, monkeypatch, at):
    from millstream.operators import marts
    from millstream.plans import aggregates

    rows = [(i, at(600 * (i % 9)), i % 40, ("view", "purchase", "error")[i % 3], 1.0) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    seen, real = [], marts.oee_kpi
    monkeypatch.setattr(aggregates.marts, "oee_kpi", lambda shifts, *a: (seen.append(shifts), real(shifts, *a))[1])
    aggregates.oee_kpi(spark, str(tmp_path))
    assert seen[0].select(F.spark_partition_id()).distinct().count() > 4


def test_exploded_sides_and_summaries_are_not_broadcast(spark):
    """Spark takes rows that were exploded to be as few as before, and would send them all through the driver."""
    days = spark.range(40).select((F.col("id") % 4).alias("k"), F.explode(F.sequence(F.lit(0), F.lit(29))).alias("d"))
    begin = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("d"))
    slots = days.select("k", "d", begin.alias("st"), (begin + F.make_dt_interval(F.lit(0), F.lit(8))).alias("fi"))
    points = days.select("k", begin.alias("t")).distinct()
    pairs = temporal.tree_pairs(points, slots, "k", "t", "st", "fi", "8 hours")
    series = chunked.following(chunked.with_time_chunk(points, "t"), "k", ["t"], ["t"], "next")
    for df, rows in ((pairs, 40 * 30), (series, 4 * 30)):
        assert df.count() == rows
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
