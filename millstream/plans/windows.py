"""Window operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.functions import timekeys as tk
from millstream.operators import aggregates as a
from millstream.operators import joins, sequences, temporal
from millstream.plans.registry import Tables, query


@query("latest_per_key", "SELECT user_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf):
    return a.latest_per_key(Tables(spark, sf).events, "user_id", ["ts", "event_id"], ["ts", "event_type", "value"])


@query(
    "first_per_halfhour",
    """SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 30 MINUTE, ts) ORDER BY ts, event_id) = 1""",
)
def first_per_halfhour(spark, sf):
    return a.first_per_slot(Tables(spark, sf).events, "event_type", "ts", ["event_id", "value"], "30 minutes", ["event_id"])


@query(
    "distinct_on",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1",
)
def distinct_on(spark, sf):
    orders = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.distinct_on(orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query(
    "topk_per_group",
    """SELECT zone, l_partkey, total, CAST(rn AS INTEGER) AS rn FROM (SELECT s_nationkey AS zone, l_partkey, sum(l_quantity) AS total, row_number() OVER (PARTITION BY s_nationkey ORDER BY sum(l_quantity) DESC, l_partkey) AS rn
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) WHERE rn <= 10""",
)
def topk_per_group(spark, sf):
    t = Tables(spark, sf)
    zones = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as zone")
    totals = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity").join(zones, "l_suppkey").groupBy("zone", "l_partkey").agg(F.sum("l_quantity").alias("total"))
    return a.topk_per_group(totals, "zone", [F.col("total").desc(), F.col("l_partkey")], 10)


@query(
    "lead_dwell",
    """WITH g AS (SELECT user_id, event_type, CAST(floor(value / 50) AS BIGINT) AS zone, min(ts) AS now_dt FROM events GROUP BY ALL),
       x AS (SELECT *, COALESCE(lead(now_dt) OVER (PARTITION BY user_id ORDER BY now_dt, event_type, zone), TIMESTAMP '2024-02-01') AS next_dt FROM g)
       SELECT user_id, event_type, zone, now_dt, next_dt, date_diff('microsecond', now_dt, next_dt) / 1000000.0 AS dwell_sec FROM x""",
)
def lead_dwell(spark, sf):
    events = Tables(spark, sf).events.withColumn("zone", F.floor(F.col("value") / 50))
    return temporal.lead_dwell(events, "user_id", ["event_type", "zone"], "ts", "2024-02-01")


SEGMENT_SQL = """SELECT *, CAST(sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS segment FROM (
    SELECT *, COALESCE(CAST(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOUR AS INTEGER), 0) AS g FROM events)"""


@query(
    "gap_segments",
    f"SELECT event_id, user_id, segment FROM ({SEGMENT_SQL}) QUALIFY max(value) OVER (PARTITION BY user_id, segment) > 50",
)
def gap_segments(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    segments = temporal.gap_segments(events, "user_id", "ts", "6 hours", ["event_id"])
    return temporal.busy_segments(segments, "user_id", "segment", "value", 50).select("event_id", "user_id", "segment")


def sparse(spark, sf):
    """Readings in which some values are missing."""
    present = (F.col("event_id") % 3 != 0) & (F.col("event_type") != "signup")
    return Tables(spark, sf).events.select(
        "event_id", "user_id", "ts", F.when(present, F.col("value")).alias("current"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("temp"),
    )


SPARSE_SQL = """SELECT event_id, user_id, ts, CASE WHEN event_id % 3 <> 0 AND event_type <> 'signup' THEN value END AS current,
   CASE WHEN event_type = 'view' THEN value END AS temp FROM events"""


@query("ffill", f"SELECT event_id, last_value(current IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS current FROM ({SPARSE_SQL})")
def ffill(spark, sf):
    return temporal.fill_series(sparse(spark, sf), "user_id", "ts", ["current"], ["event_id"]).select("event_id", "current")


@query("bfill", f"SELECT event_id, first_value(current IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS current FROM ({SPARSE_SQL})")
def bfill(spark, sf):
    return temporal.fill_series(sparse(spark, sf), "user_id", "ts", ["current"], ["event_id"], backward=True).select("event_id", "current")


@query(
    "ffill_bfill",
    f"""WITH s AS (SELECT * FROM ({SPARSE_SQL}) WHERE current IS NOT NULL OR temp IS NOT NULL)
        SELECT event_id, """
    + ", ".join(
        f"""COALESCE(last_value({x} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value({x} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {x}"""
        for x in ("current", "temp")
    )
    + " FROM s",
)
def ffill_bfill(spark, sf):
    filled = temporal.ffill_bfill(sparse(spark, sf), "user_id", "ts", ["current", "temp"], ["event_id"])
    return filled.select("event_id", "current", "temp")


@query(
    "interpolate_linear",
    f"""WITH s AS (SELECT *, row_number() OVER w AS rn FROM ({SPARSE_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        x AS (SELECT *, last_value(CASE WHEN current IS NOT NULL THEN rn END IGNORE NULLS) OVER p AS r0, last_value(current IGNORE NULLS) OVER p AS v0,
                first_value(CASE WHEN current IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS r1, first_value(current IGNORE NULLS) OVER f AS v1 FROM s
              WINDOW p AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT event_id, round(CASE WHEN current IS NOT NULL THEN current WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (rn - r0) / (r1 - r0) ELSE v0 END, 6) AS current FROM x""",
)
def interpolate_linear(spark, sf):
    rows = temporal.interpolate_linear(sparse(spark, sf), "user_id", "ts", "current", "filled", ["event_id"])
    return rows.select("event_id", F.round("filled", 6).alias("current"))


@query(
    "resample_linear",
    """WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
       p AS (SELECT DISTINCT user_id, n, unnest(range(50)) AS point FROM s), q AS (SELECT *, point * (n - 1) / 49.0 AS pos FROM p)
       SELECT q.user_id, CAST(point AS INTEGER) AS point, round(a.value + (COALESCE(b.value, a.value) - a.value) * (pos - a.i), 6) AS value
       FROM q JOIN s a ON a.user_id = q.user_id AND a.i = CAST(floor(point * (q.n - 1) / 49) AS BIGINT) LEFT JOIN s b ON b.user_id = q.user_id AND b.i = a.i + 1""",
)
def resample_linear(spark, sf):
    points = temporal.resample_linear(Tables(spark, sf).events, "user_id", "ts", ["value"], 50, ["event_id"])
    return points.withColumn("value", F.round("value", 6))


SEQ_SQL = """SELECT user_id, rn, n, CASE WHEN rn <= n - 20 THEN list(value) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS w, event_id
   FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)"""


@query("sliding_sequences", f"SELECT user_id, rn, array_to_string(w, ',') AS window_text FROM ({SEQ_SQL}) WHERE w IS NOT NULL")
def sliding_sequences(spark, sf):
    windows = sequences.sliding_sequences(Tables(spark, sf).events, "user_id", "ts", "value", 20, tiebreak=["event_id"])
    text = F.array_join(F.transform("window", lambda v: v.cast("string")), ",")
    return windows.select("user_id", "rn", text.alias("window_text"))


@query("model_score_windows", f"SELECT user_id, rn, round(list_var_pop(w), 6) AS score FROM ({SEQ_SQL}) WHERE w IS NOT NULL")
def model_score_windows(spark, sf):
    windows = sequences.sliding_sequences(Tables(spark, sf).events, "user_id", "ts", "value", 20, tiebreak=["event_id"])

    def load():
        return lambda matrix: ((matrix - matrix.mean(axis=1, keepdims=True)) ** 2).mean(axis=1)

    scored = sequences.model_score_windows(windows, sequences.batch_scorer(load))
    return scored.select("user_id", "rn", F.round("score", 6).alias("score"))


@query(
    "window_anomaly_removal",
    f"""WITH s AS ({SEQ_SQL}), e AS (SELECT user_id, rn, list_var_pop(w) AS err FROM s WHERE w IS NOT NULL),
        q AS (SELECT user_id, quantile_cont(err, 0.25) AS q1, quantile_cont(err, 0.75) AS q3 FROM e GROUP BY user_id),
        f AS (SELECT e.user_id, rn FROM e JOIN q ON e.user_id = q.user_id WHERE err < q1 - 1.5 * (q3 - q1) OR err > q3 + 1.5 * (q3 - q1))
        SELECT event_id, user_id FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = s.user_id AND s.rn BETWEEN f.rn AND f.rn + 19)""",
)
def window_anomaly_removal(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    kept = sequences.window_anomaly_removal(events, "user_id", "ts", "value", 20, tiebreak=["event_id"])
    return kept.select("event_id", "user_id")


@query(
    "range_filter_min_points",
    """WITH p AS (SELECT user_id, date_trunc('hour', ts) AS hour_ts, avg(value) AS value FROM events WHERE value > 5 AND value < 80 GROUP BY 1, 2)
       SELECT user_id, hour_ts, round(value, 6) AS value FROM p QUALIFY count(*) OVER (PARTITION BY user_id) >= 50""",
)
def range_filter_min_points(spark, sf):
    hourly = Tables(spark, sf).events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_ts"), "value")
    kept = sequences.range_filter_min_points(hourly, "user_id", "hour_ts", "value", 5, 80, 50)
    return kept.withColumn("value", F.round("value", 6))


@query(
    "overlap_trim",
    """WITH p AS (SELECT o_custkey, o_orderkey, o_orderdate AS st, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2001-12-31' ELSE o_orderdate + to_days(CAST(floor(o_totalprice / 2000) AS INTEGER)) END AS fi FROM orders),
       x AS (SELECT *, lead(st) OVER (PARTITION BY o_custkey ORDER BY st, fi, o_orderkey) AS nx FROM p)
       SELECT o_custkey, o_orderkey, st, CASE WHEN fi > nx THEN nx ELSE fi END AS fi FROM x""",
)
def overlap_trim(spark, sf):
    days = F.make_dt_interval(F.floor(F.col("o_totalprice") / 2000).cast("int"))
    finish = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + days)
    periods = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("st"), finish.alias("fi"))
    return temporal.overlap_trim(periods, "o_custkey", "st", "fi", "2001-12-31", ["o_orderkey"], "30 days")


_MIN = "(hour(ts) * 60 + minute(ts))"
_DOW = "(isodow(ts) - 1)"


@query(
    "shift_of_timestamp",
    f"""SELECT event_id, CAST(CASE WHEN {_MIN} < 390 THEN CASE WHEN ({_DOW} + 6) % 7 <= 4 THEN 3 END
          WHEN {_DOW} <= 3 THEN CASE WHEN {_MIN} < 870 THEN 1 WHEN {_MIN} < 1350 THEN 2 ELSE 3 END
          WHEN {_DOW} = 4 THEN CASE WHEN {_MIN} < 900 THEN 1 WHEN {_MIN} < 1350 THEN 2 ELSE 3 END
          WHEN {_DOW} = 5 THEN CASE WHEN {_MIN} < 690 THEN 1 WHEN {_MIN} < 990 THEN 2 WHEN {_MIN} < 1290 THEN 3 END END AS INTEGER) AS shift FROM events""",
)
def shift_of_timestamp(spark, sf):
    return Tables(spark, sf).events.select("event_id", tk.shift_of_timestamp("ts").alias("shift"))


_D = "date_trunc('day', ts)"


@query(
    "shift_window",
    f"""WITH x AS (SELECT event_id, ts, CASE
          WHEN {_DOW} <= 3 THEN CASE WHEN {_MIN} < 390 THEN {_D} - INTERVAL 90 MINUTE WHEN {_MIN} < 870 THEN {_D} + INTERVAL 390 MINUTE WHEN {_MIN} < 1350 THEN {_D} + INTERVAL 870 MINUTE ELSE {_D} + INTERVAL 1350 MINUTE END
          WHEN {_DOW} = 4 THEN CASE WHEN {_MIN} < 390 THEN {_D} - INTERVAL 90 MINUTE WHEN {_MIN} < 900 THEN {_D} + INTERVAL 390 MINUTE WHEN {_MIN} < 1380 THEN {_D} + INTERVAL 900 MINUTE ELSE {_D} + INTERVAL 1350 MINUTE END
          WHEN {_DOW} = 5 THEN CASE WHEN {_MIN} < 390 THEN NULL WHEN {_MIN} < 690 THEN {_D} + INTERVAL 390 MINUTE WHEN {_MIN} < 990 THEN {_D} + INTERVAL 690 MINUTE ELSE {_D} + INTERVAL 990 MINUTE END END AS st FROM events)
        SELECT event_id, st AS shift_start, CASE WHEN hour(st) * 60 + minute(st) IN (690, 990) THEN st + INTERVAL 5 HOUR ELSE st + INTERVAL 8 HOUR END AS shift_end,
               strftime(COALESCE(st, ts), '%Y%m%d') AS business_date FROM x""",
)
def shift_window(spark, sf):
    start, end, day = tk.shift_window("ts")
    return Tables(spark, sf).events.select(
        "event_id", start.alias("shift_start"), end.alias("shift_end"), F.date_format(day, "yyyyMMdd").alias("business_date")
    )


@query(
    "business_date_pair",
    "SELECT event_id, strftime(ts - INTERVAL 6 HOUR - INTERVAL 1 DAY, '%Y%m%d') AS date_1, strftime(ts - INTERVAL 6 HOUR, '%Y%m%d') AS date_2 FROM events",
)
def business_date_pair(spark, sf):
    first, second = tk.business_date_pair("ts")
    return Tables(spark, sf).events.select(
        "event_id", F.date_format(first, "yyyyMMdd").alias("date_1"), F.date_format(second, "yyyyMMdd").alias("date_2")
    )


@query(
    "cycle_numbering",
    f"SELECT event_id, row_number() OVER (PARTITION BY user_id, segment ORDER BY ts, event_id) AS cycle_no FROM ({SEGMENT_SQL})",
)
def cycle_numbering(spark, sf):
    from millstream.operators.cycles import cycle_numbering as number

    events = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    segments = temporal.gap_segments(events, "user_id", "ts", "6 hours", ["event_id"])
    return number(segments, ["user_id", "segment"], "ts", tiebreak=["event_id"]).select("event_id", "cycle_no")


@query(
    "sequence_no",
    "SELECT event_id, 'mixer03_' || strftime(ts, '%Y%m%d') || '_' || row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY ts, event_id) AS no FROM events",
)
def sequence_no(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "ts")
    return temporal.sequence_no(events, "ts", ["ts", "event_id"], "mixer03").select("event_id", "no")
