"""Operators on small literal frames, with the quirks they keep."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millstream.operators import alerts, joins, observability, quality, quantiles, sequences, sets, spc, temporal
from millstream.sources import progress, readers, snapshots, writers
from millstream.session import shared_path


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_exact_quantiles(spark, n):
    rng = random.Random(n)
    values = [float(rng.choice([1, 1, 2, 5, rng.randrange(1000)])) for _ in range(n)]
    df = spark.createDataFrame([("k", v) for v in values] + [("k", None)], "k string, v double")
    got = quantiles.exact_quantiles(df, "k", "v", [0.0, 0.25, 0.5, 0.9, 1.0], list("abcde")).collect()[0]
    assert list(got)[1:6] == pytest.approx(list(np.percentile(values, [0, 25, 50, 90, 100])))


def test_exact_quantiles_beyond_sketch_accuracy(spark):
    df = spark.range(60_000).select(F.lit("k").alias("k"), (F.col("id") % 50_021).cast("double").alias("v"))
    values = np.arange(60_000) % 50_021
    got = quantiles.exact_quantiles(df, "k", "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()[0]
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(np.percentile(values, [25, 50, 75])))


def test_nelson_rules_on_known_series(spark):
    values = [0.5] * 9 + [5.0] + [-0.1, -0.2, -0.3, -0.4, -0.5, -0.6] + [0.1, -0.1] * 8
    rows = [("k", i + 1, v, 1.0, 0.0, -1.0) for i, v in enumerate(values)]
    points = spark.createDataFrame(rows, "k string, idx long, value double, ucl double, cl double, lcl double")
    flagged = spc.nelson_first_violation(points, "k")
    got = {r["idx"]: r["violated_rule"] for r in flagged.collect()}
    assert got[9] == 2 and got[10] == 1 and got[8] == 0
    assert got[15] == 3 and got[16] == 3
    # The steps into 16, 17, ... alternate, so 28 is the first point that ends fourteen alternating ones.
    assert got[27] == 0 and got[28] == 4 and got[32] == 4
    tail = {r["idx"]: r["violated_rule"] for r in spc.nelson_first_violation(points, "k", tail_only=True).collect()}
    assert tail[1] == 4 and tail[10] == 1


def test_p_chart_counts_tail_defects(spark, at):
    marks = "NYYYYNYYYYNN"
    df = spark.createDataFrame([("k", at(i), m) for i, m in enumerate(marks)], "k string, ts timestamp_ntz, r string")
    rows = spc.spc_p_chart(df, "k", "ts", F.col("r") == "N", 5).collect()
    assert len(rows) == 2 and rows[0]["cl"] == pytest.approx(4 / 10)


def test_sliding_sequences_leave_out_the_last(spark, at):
    df = spark.createDataFrame([("k", at(i), float(i)) for i in range(6)], "k string, ts timestamp_ntz, v double")
    rows = sequences.sliding_sequences(df, "k", "ts", "v", 4).collect()
    assert sorted((r["rn"], list(r["window"])) for r in rows) == [(1, [0, 1, 2, 3]), (2, [1, 2, 3, 4])]
    assert sequences.sliding_sequences(df, "k", "ts", "v", 4, drop_last=False).count() == 3
    short = sequences.window_anomaly_removal(df, "k", "ts", "v", 10)
    assert short.count() == 6


def test_model_scorer_batches(spark):
    df = spark.createDataFrame([([float(i), 1.0],) for i in range(300)], "window array<double>")
    scorer = sequences.batch_scorer(lambda: lambda m: m.sum(axis=1), batch=128)
    total = sequences.model_score_windows(df, scorer).agg(F.sum("score")).collect()[0][0]
    assert total == sum(range(300)) + 300


def test_missing_probability(spark):
    df = spark.createDataFrame([(0.05, True), (0.05, False), (0.2, True), (None, True)], "p double, is_3_stage boolean")
    rows = sequences.model_score_cycles(df, "p", lambda p: p).collect()
    assert [(r["anomaly_prob"], r["is_anomaly"], r["result"]) for r in rows] == [
        (0.05, True, True), (0.05, True, False), (0.2, False, False), (0.5, False, False)
    ]


def test_resample_single_row_and_ends(spark, at):
    df = spark.createDataFrame([("one", at(0), 7.0), ("k", at(0), 0.0), ("k", at(1), 10.0), ("k", at(500), 40.0)], "k string, ts timestamp_ntz, v double")
    points = temporal.resample_linear(df, "k", "ts", ["v"], 5)
    vectors = {r["k"]: list(r["vector"]) for r in temporal.point_vectors(points, "k", ["v"]).collect()}
    assert vectors == {"one": [7.0] * 5, "k": pytest.approx(list(np.interp(np.linspace(0, 1, 5), [0, 0.5, 1], [0, 10, 40])))}


def test_anti_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    bad = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r["k"] for r in joins.anti_join_null_safe(df, bad, "k").collect()} == {2, None}


@pytest.fixture
def shuffled(spark):
    """Joins with a shuffle, as on tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_null_keys_of_anti_joins_do_not_meet_in_a_task(shuffled):
    df = shuffled.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    bad = shuffled.range(0, 4000, 20, 8).select(F.col("id").alias("k"))
    for kept in (joins.anti_join_null_safe(df, bad, "k"), joins.orphan_rows(df, bad, "k")):
        assert kept.columns == ["k", "id"] and kept.count() == 3800 and kept.filter("k is null").count() == 3600
        assert largest_task(kept) < 1000


def test_unreadable_keys_of_left_joins_do_not_meet_in_a_task(shuffled):
    key = F.when(F.col("id") % 10 == 0, F.concat(F.lit(" "), "id")).otherwise("x")
    left = shuffled.range(0, 4000, 1, 8).select("id", key.alias("k"))
    right = shuffled.range(0, 4000, 20, 8).select(F.concat(F.lit("0"), "id").alias("r"), (F.col("id") + 1).alias("v"))
    joined = joins.left_join_numeric_key(left, right, "k", "r")
    assert joined.columns == ["id", "k", "v"] and joined.count() == 4000
    assert joined.filter("v = id + 1").count() == 200 and joined.filter("v is null").count() == 3800
    assert largest_task(joined) < 1000


def test_wildcards_equal_nested_loop(spark):
    rng = random.Random(5)
    fields = ["factory", "building", "floor"]

    def pick(*xs):
        return rng.choice(xs)

    alerts_ = [(i, pick("s1", "s2", None), pick("f1", "f2", None), pick("b1", "b2", None), pick(0, 1, None)) for i in range(60)]
    subs = [(i, pick(None, None, None, "s1"), pick("f1", None), pick("b1", "b2", None), pick(0, 1, None)) for i in range(30)]
    schema = "{} int, sensor string, factory string, building string, floor int"
    got = joins.wildcard_match_join(
        spark.createDataFrame(alerts_, schema.format("a")), spark.createDataFrame(subs, schema.format("s")), "a", "s", "sensor", fields
    )
    want = set()
    for a in alerts_:
        for s in subs:
            exact = a[1] is not None and s[1] == a[1]
            open_sensor = s[1] is None or a[1] is None
            place = all(x is None or x == y for x, y in zip(s[2:], a[2:]))
            if exact or (open_sensor and place):
                want.add((a[0], s[0]))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_threshold_status(spark):
    limits = spark.createDataFrame(
        [(1, "t", "medium", 10.0, None), (2, "t", "red", None, 5.0), (3, "t", "orange", 30.0, 40.0), (4, "t", "red", 30.0, 35.0)],
        "threshold_id int, kind string, level string, min_value double, max_value double",
    )
    rows = spark.createDataFrame([(i, "t", float(i)) for i in range(0, 60, 3)] + [(99, "t", None), (98, "u", 1.0)], "id int, kind string, v double")
    small = {r["id"]: (r["threshold_id"], r["status"]) for r in alerts.threshold_status(rows, limits, "kind", "v", "threshold_id").collect()}
    assert small[3] == (2, "critical") and small[33] == (3, "critical") and small[12] == (1, "warning")
    assert small[6] == (None, "normal") and small[99] == (None, "normal") and small[98] == (None, "normal")


def test_threshold_status_of_readings_with_one_id(spark):
    """Each reading is judged by its own value, also where ids repeat and thresholds are many."""
    limits = spark.range(12_000).selectExpr("cast(id as int) threshold_id", "'t' kind", "if(id = 7, 'red', 'low') level", "if(id = 7, 50.0D, 1000.0D + id) min_value", "cast(null as double) max_value")
    rows = spark.createDataFrame([(1, "t", 10.0), (1, "t", 60.0)], "id int, kind string, v double")
    got = alerts.threshold_status(rows, limits, "kind", "v", "threshold_id")
    assert {(r["v"], r["status"]) for r in got.collect()} == {(10.0, "normal"), (60.0, "critical")}


def test_best_subscription_prefers_level(spark):
    rows = [(1, 10, "u", "n", None, 0), (1, 11, "u", "n", "yellow", 2), (1, 12, "u", "n", "red", 4), (1, 13, "u", "n", "red", 4), (1, 14, "w", "n", "", 0), (1, 15, "w", "n", None, 0)]
    df = spark.createDataFrame(rows, "alert_id int, subscription_id int, subscriber string, notify_id string, min_level string, min_priority int")
    got = {(r["subscriber"], r["subscription_id"]) for r in alerts.alert_best_per_recipient(df).collect()}
    assert got == {("u", 12), ("w", 14)}


ALERT = "alert_id int, sensor_id string, alert_level string, threshold_type int, factory string, floor int"
SUB = "subscription_id int, subscriber string, notify_id int, min_level string, threshold_type int, sensor_id string, factory string, floor int, enabled boolean"


@pytest.mark.parametrize("seed", range(3))
def test_best_by_place_equals_best_of_all_pairs(spark, seed):
    rng = random.Random(seed)

    def pick(*values):
        return rng.choice(values)

    raised = [(i, pick("s1", "s2", None), pick("green", "yellow", "critical", "odd", None), pick(0, 1), pick("f1", "f2", None), pick(0, 1, None)) for i in range(70)]
    raised += raised[:5] + [(None, None, "red", 0, "f1", 1)]
    subs = [(i, pick("u", "w"), pick(0, 1, None), pick("yellow", "RED", "Medium", "", None), pick(0, 1), pick(None, None, "s1", "s9"), pick("f1", None), pick(0, 1, None), pick(True, True, False, None)) for i in range(90)]
    found = spark.createDataFrame(raised, ALERT), spark.createDataFrame(subs, SUB)
    recipient, fields = ["subscriber", "notify_id"], ["factory", "floor"]
    all_pairs = alerts.alert_candidates(*found, fields=fields)
    few = alerts.alert_candidates(*found, fields=fields, best_only=recipient)
    rows = [sorted(map(str, alerts.alert_best_per_recipient(x).select("alert_id", *recipient, "subscription_id", "min_level").collect())) for x in (all_pairs, few)]
    assert rows[0] == rows[1] and len(rows[0]) > 100


def test_pairs_for_the_best_do_not_grow_with_sensors(spark):
    """Alerts without sensor meet the subscriptions of all sensors, of which one a recipient can be the best."""
    raised = spark.range(50).selectExpr("cast(id as int) alert_id", "cast(null as string) sensor_id", "'red' alert_level", "0 threshold_type", "'f1' factory", "1 floor")
    subs = spark.range(200).selectExpr(
        "cast(id as int) subscription_id", "'u' subscriber", "cast(id % 2 as int) notify_id", "if(id % 4 < 2, 'red', 'yellow') min_level", "0 threshold_type",
        "concat('s', id) sensor_id", "if(id % 3 = 0, 'f1', null) factory", "cast(null as int) floor", "true enabled",
    )
    pairs = alerts.alert_candidates(raised, subs, fields=["factory", "floor"], best_only=["subscriber", "notify_id"])
    assert pairs.count() == 50 * 2
    assert {r.subscription_id for r in pairs.collect()} == {0, 1}


def daily(spark, counts, first=dt.date(2024, 1, 1)):
    rows = [(dt.datetime.combine(first + dt.timedelta(days=i), dt.time(1)), j) for i, n in enumerate(counts) for j in range(n)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, j int")


def last_point(df):
    return df.orderBy(F.desc("bucket")).first()


def test_volume_spike_drop_and_small_changes(spark):
    spike = daily(spark, [1] * 20 + [2])
    assert last_point(observability.do_volume_anomalies(spike, "ts"))["is_anomalous"]
    assert not last_point(observability.do_volume_anomalies(spike, "ts", direction="drop"))["is_anomalous"]
    drop = daily(spark, [30] * 20 + [29])
    assert last_point(observability.do_volume_anomalies(drop, "ts"))["is_anomalous"]
    assert not last_point(observability.do_volume_anomalies(drop, "ts", ignore_drop_pct=5))["is_anomalous"]
    deep = daily(spark, [30] * 20 + [25])
    assert last_point(observability.do_volume_anomalies(deep, "ts", ignore_drop_pct=5))["is_anomalous"]


def test_volume_sensitivity(spark):
    df = daily(spark, [1, 2] * 12 + [3])
    assert not last_point(observability.do_volume_anomalies(df, "ts", sensitivity=3))["is_anomalous"]
    assert last_point(observability.do_volume_anomalies(df, "ts", sensitivity=2))["is_anomalous"]


def test_exclude_metrics_uncovers_anomaly(spark):
    df = daily(spark, [1] * 12 + [10, 1, 10, 1, 10])
    points = observability.bucket_metrics(df, "ts", "1 day", {"row_count": F.count(F.lit(1))})
    assert not last_point(observability.score(points))["is_anomalous"]
    exclude = F.col("bucket").cast("date").isin(dt.date(2024, 1, 13), dt.date(2024, 1, 15))
    assert last_point(observability.score(points, exclude=exclude))["is_anomalous"]


def test_backfill_start(spark):
    span = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 30))], "first timestamp_ntz, last timestamp_ntz")

    def begin(stored, **kwargs):
        rows = [] if stored is None else [("m", dt.datetime(2024, 1, stored))]
        history = spark.createDataFrame(rows, "metric string, bucket timestamp_ntz")
        return observability.backfill_from(history, "m", span, 3, **kwargs).collect()[0][0].day

    assert (begin(None), begin(29), begin(20), begin(10, stale_buckets=14)) == (1, 28, 21, 1)


def test_exclusive_ranges_golden(spark):
    d = dt.date
    rows = [(1, d(2019, 1, 1), d(2019, 2, 1)), (1, d(2019, 3, 3), d(2019, 4, 1)), (2, d(2019, 5, 6), d(2019, 7, 2)), (2, d(2019, 7, 3), None)]
    df = spark.createDataFrame(rows, "id int, f date, t date")
    assert quality.dq_mutually_exclusive_ranges(df, "f", "t", ["id"], gaps="required").isEmpty()
    assert quality.dq_mutually_exclusive_ranges(df, "f", "t", ["id"], gaps="not_allowed").count() == 2
    bad = df.union(spark.createDataFrame([(1, d(2019, 1, 15), d(2019, 1, 15))], df.schema))
    assert quality.dq_mutually_exclusive_ranges(bad, "f", "t", ["id"]).count() == 2


def test_json_rules(spark):
    schema = {"n": {"type": "number", "required": True}, "s": {"type": "string", "maxLength": 3}}
    texts = ['{"n": 1}', '{"n": 1.5, "s": "abc"}', '{"s": "abc"}', '{"n": "1"}', '{"n": 1, "s": "abcd"}', "nope", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, j string")
    assert sorted(r["id"] for r in observability.do_jsonschema(df, "j", schema).collect()) == [2, 3, 4, 5, 6]


def test_upsert_keeps_columns_that_are_not_given(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 10, "x"), (2, "b", 20, "x")], "id int, name string, qty int, part string")
    for by in ((), ("part",)):
        snapshots.replace(spark, path + str(len(by)), first, by)
        later = spark.createDataFrame([(2, 21, "x", 1.5), (3, 30, "x", 2.5)], "id int, qty int, part string, extra double")
        writers.upsert(spark, path + str(len(by)), later, ["id", "part"], [F.col("qty")], by)
        got = {r["id"]: (r["name"], r["qty"], r["extra"]) for r in snapshots.read(spark, path + str(len(by))).collect()}
        assert got == {1: ("a", 10, None), 2: ("b", 21, 1.5), 3: (None, 30, 2.5)}


def test_numbers_of_any_length_in_order(spark):
    names = ["s_9", "s_1234567890123999", "s_1234567890124000", "s_0010", "s_9999999999999", "s_10a2", "s_10a10", "s"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    order = [r["c"] for r in sets.natural_sort(df, "c").collect()]
    assert order == ["s", "s_9", "s_0010", "s_10a2", "s_10a10", "s_9999999999999", "s_1234567890123999", "s_1234567890124000"]


def test_predicates_keep_microseconds():
    import datetime as dt

    bounds = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5, 678)]
    assert readers.range_predicates("t", bounds, "jdbc:postgresql://h/d") == ["t >= TIMESTAMP '2024-01-01 00:00:00' AND t <= TIMESTAMP '2024-01-02 03:04:05.000678'"]
    assert readers.range_predicates("t", bounds, "jdbc:sqlserver://h")[0].startswith("t >= '2024-01-01 00:00:00' AND")


def test_natural_sort(spark):
    df = spark.createDataFrame([("st_10",), ("st_2",), ("st_1",)], "c string")
    assert [r["c"] for r in sets.natural_sort(df, "c").collect()] == ["st_1", "st_2", "st_10"]


def test_upsert_replaces_and_keeps(spark):
    path = shared_path(spark, "test-upsert")
    schema = "k int, day string, v int"
    writers.upsert(spark, path, spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], schema), ["k", "day"], [F.col("v")], ["day"])
    writers.upsert(spark, path, spark.createDataFrame([(2, "a", 20), (2, "a", 21), (4, "a", 4)], schema), ["k", "day"], [F.col("v").desc()], ["day"])
    rows = {(r["k"], r["v"]) for r in snapshots.read(spark, path).collect()}
    assert rows == {(1, 1), (2, 21), (3, 3), (4, 4)}


def test_multi_sink_reports_failures(spark):
    def broken(df):
        raise OSError("target is down")

    path = shared_path(spark, "test-sink")
    status = writers.multi_sink(spark.range(3).toDF("id"), {"a": broken, "b": lambda df: writers.replace_table(df, path)})
    assert status == {"a": "failed: OSError", "b": "success"} and spark.read.parquet(path).count() == 3


def test_csv_routes_drop_malformed(spark):
    lines = spark.createDataFrame([("20240101,1,CUR1,d,t,1,2,x",), ("20240101,1,VIB1,d,t,1,2,3,4",), ("short,line",)], "value string")
    head = ["ymd", "hmsf", "sensor_id", "device_id", "capture_dt"]
    frames = readers.csv_routes(lines, {"CUR": [*head, "r", "s", "t"], "VIB": [*head, "x", "y", "z", "freq"]})
    assert frames["CUR"].collect()[0]["t"] is None and frames["VIB"].collect()[0]["freq"] == 4.0


def test_progress_moves_only_for_finished(spark):
    state = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))], "job string, marker timestamp_ntz")
    done = spark.createDataFrame([("a", dt.datetime(2024, 1, 2))], "job string, range_end timestamp_ntz")
    after = {r["job"]: r["marker"].day for r in progress.advance(state, "job", "marker", done).collect()}
    assert after == {"a": 2, "b": 1}


def test_incremental_range_waits_at_margin(spark):
    state = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 11, 57))], "job string, marker timestamp_ntz")
    got = progress.incremental_range(state, "job", "marker", "2024-01-01 12:20:00", "1 hour", "10 minutes", align="10 minutes").collect()
    assert [(r["range_start"].minute, r["range_end"].hour, r["range_end"].minute) for r in got] == [(50, 12, 10)]
    assert progress.incremental_range(state, "job", "marker", "2024-01-01 11:58:00", align="10 minutes").isEmpty()


def test_pairs_of_one_file_are_made_in_many_tasks(spark):
    alerts_ = spark.range(2000).selectExpr("cast(id as int) a", "cast(null as string) sensor", "'f1' factory").coalesce(1)
    subs = spark.createDataFrame([(i, None, "f1" if i % 2 else None) for i in range(10)], "s int, sensor string, factory string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = joins.wildcard_match_join(alerts_, subs, "a", "s", "sensor", ["factory"])
        shares = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(shares) == 20_000 and max(shares) < 10_000
