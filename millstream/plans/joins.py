"""Joins over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.functions.timekeys import interval
from millstream.operators import joins, temporal
from millstream.plans.registry import Tables, query


@query(
    "inner_equi_join",
    """SELECT l_orderkey, l_linenumber, o_orderpriority, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE o_orderstatus = 'F'""",
)
def inner_equi_join(spark, sf):
    t = Tables(spark, sf)
    plans = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus")
    lots = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.inner_equi_join(lots, plans, "l_orderkey", F.col("o_orderstatus") == "F").drop("o_orderstatus")


@query(
    "composite_key_join",
    """SELECT o_orderkey, l_linenumber, s_nationkey, p_name, l_quantity FROM orders
       JOIN lineitem ON l_orderkey = o_orderkey AND year(l_shipdate) = year(o_orderdate)
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
)
def composite_key_join(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("wo_year"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("wo_year"), "l_linenumber", "l_suppkey",
        "l_partkey", "l_quantity",
    )
    machines = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey")
    parts = t.part.selectExpr("p_partkey as l_partkey", "p_name")
    steps = [(lines, ["o_orderkey", "wo_year"]), (machines, ["l_suppkey"]), (parts, ["l_partkey"])]
    joined = joins.composite_key_join(orders, steps)
    return joined.select("o_orderkey", "l_linenumber", "s_nationkey", "p_name", "l_quantity")


@query(
    "left_join_with_on_filter",
    """SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
       AND l_returnflag = 'R' AND l_linestatus = 'F'""",
)
def left_join_with_on_filter(spark, sf):
    t = Tables(spark, sf)
    lots = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    done = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    joined = joins.left_join_with_on_filter(t.orders.select("o_orderkey"), lots, "o_orderkey", done)
    return joined.select("o_orderkey", "l_linenumber", "l_quantity")


@query(
    "left_join_numeric_key",
    """SELECT l_orderkey, l_linenumber, o_totalprice FROM (SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN 'x' ELSE ' ' || l_orderkey END AS k FROM lineitem)
       LEFT JOIN orders ON TRY_CAST(trim(k) AS BIGINT) = o_orderkey""",
)
def left_join_numeric_key(spark, sf):
    t = Tables(spark, sf)
    key = F.when(F.col("l_returnflag") == "R", "x").otherwise(F.concat(F.lit(" "), "l_orderkey"))
    lots = t.lineitem.select("l_orderkey", "l_linenumber", key.alias("so_id"))
    runs = t.orders.select(F.concat(F.lit("0"), "o_orderkey").alias("rst_so_id"), "o_totalprice")
    return joins.left_join_numeric_key(lots, runs, "so_id", "rst_so_id").select("l_orderkey", "l_linenumber", "o_totalprice")


@query(
    "left_join_neutralised",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'P'""",
)
def left_join_neutralised(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return joins.left_join_neutralised(
        t.customer.select("c_custkey"), orders, "c_custkey", F.col("o_orderstatus") == "P"
    ).drop("o_orderstatus")


@query(
    "full_outer_chain",
    """WITH p AS (SELECT o_custkey AS k, year(o_orderdate) AS y, count(*) AS plan_qty FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2),
       r AS (SELECT o_custkey AS k, year(o_orderdate) AS y, sum(o_totalprice) AS prod_qty FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
       d AS (SELECT l_suppkey AS k, year(l_shipdate) AS y, sum(l_quantity) AS defect_qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
       SELECT COALESCE(p.k, r.k, d.k) AS key, CAST(COALESCE(p.y, r.y, d.y) AS INTEGER) AS year, CAST(COALESCE(plan_qty, 0) AS DOUBLE) AS plan_qty,
              round(COALESCE(prod_qty, 0), 2) AS prod_qty, COALESCE(defect_qty, 0) AS defect_qty
       FROM p FULL JOIN r ON p.k = r.k AND p.y = r.y FULL JOIN d ON COALESCE(p.k, r.k) = d.k AND COALESCE(p.y, r.y) = d.y""",
)
def full_outer_chain(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select(
        F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice", F.lit(1.0).alias("one")
    )
    bad = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("key"), F.year("l_shipdate").alias("year"), "l_quantity"
    )
    sides = {
        "plan_qty": (orders.filter("o_orderstatus = 'O'"), "one"),
        "prod_qty": (orders.filter("o_orderstatus = 'F'"), "o_totalprice"),
        "defect_qty": (bad, "l_quantity"),
    }
    chain = joins.full_outer_chain(sides, ["key", "year"], 0.0)
    return chain.withColumn("prod_qty", F.round("prod_qty", 2))


@query(
    "cross_join_params",
    """SELECT event_id, ts, t.start_dt FROM events CROSS JOIN (SELECT TIMESTAMP '2024-01-10 06:30:00' AS start_dt, TIMESTAMP '2024-01-10 14:30:00' AS end_dt) t
       WHERE ts >= t.start_dt AND ts < t.end_dt""",
)
def cross_join_params(spark, sf):
    window = {
        "start_dt": F.lit("2024-01-10 06:30:00").cast("timestamp_ntz"),
        "end_dt": F.lit("2024-01-10 14:30:00").cast("timestamp_ntz"),
    }
    joined = joins.cross_join_params(Tables(spark, sf).events, window)
    return joined.filter("ts >= start_dt and ts < end_dt").select("event_id", "ts", "start_dt")


ALARMS = {"pump": 1, "fan": 2, "valve": 3, "motor": 4}


@query(
    "cross_join_alarm_map",
    """SELECT event_id, alarm_name, CAST(substr(lpad(bin(event_id % 16), 4, '0'), bit_pos, 1) AS INTEGER) AS status_value
       FROM events CROSS JOIN (VALUES ('pump', 1), ('fan', 2), ('valve', 3), ('motor', 4)) m(alarm_name, bit_pos)""",
)
def cross_join_alarm_map(spark, sf):
    status = Tables(spark, sf).events.select("event_id", F.lpad(F.bin(F.col("event_id") % 16), 4, "0").alias("digitals"))
    return joins.cross_join_alarm_map(status, "digitals", ALARMS).select("event_id", "alarm_name", "status_value")


@query(
    "lateral_latest",
    """SELECT c_custkey, l.ts, l.value FROM customer LEFT JOIN LATERAL (
         SELECT ts, value FROM events WHERE user_id = c_custkey AND event_type = 'error' AND ts >= TIMESTAMP '2024-01-20 00:00:00'
         ORDER BY ts DESC, value DESC LIMIT 1) l ON true""",
)
def lateral_latest(spark, sf):
    t = Tables(spark, sf)
    errors = t.events.filter("event_type = 'error'").withColumnRenamed("user_id", "c_custkey")
    devices = t.customer.select("c_custkey")
    return joins.lateral_latest(devices, errors, "c_custkey", "ts", ["value"], "10 days", "2024-01-30 00:00:00")


# Mount periods: each customer's order opens a period that lasts for a price-dependent number of days, so
# periods of one customer overlap. Defects: shipments of the customer's lines.
PERIODS_SQL = """SELECT o_custkey AS k, o_orderkey AS period_id, o_orderdate AS st,
    o_orderdate + to_days(CAST(floor(o_totalprice / 4000) AS INTEGER)) AS fi FROM orders"""
DEFECTS_SQL = """SELECT l_orderkey, l_linenumber, o_custkey AS k, l_shipdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def periods(spark, sf):
    days = F.make_dt_interval(F.floor(F.col("o_totalprice") / 4000).cast("int"))
    return Tables(spark, sf).orders.select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("period_id"), F.col("o_orderdate").alias("st"),
        (F.col("o_orderdate") + days).alias("fi"),
    )


def defects(spark, sf):
    t = Tables(spark, sf)
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("k"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"))
    return lines.join(owner, "l_orderkey")


@query(
    "interval_join_first",
    f"""WITH p AS ({PERIODS_SQL}), d AS ({DEFECTS_SQL})
        SELECT l_orderkey, l_linenumber, k, ts, arg_min(period_id, (st, fi, period_id)) AS period_id, min(st) AS st
        FROM d LEFT JOIN p USING (k) WHERE ts BETWEEN st AND fi GROUP BY ALL
        UNION ALL SELECT l_orderkey, l_linenumber, k, ts, NULL, NULL FROM d
        WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = d.k AND d.ts BETWEEN p.st AND p.fi)""",
)
def interval_join_first(spark, sf):
    joined = temporal.interval_join_first(
        defects(spark, sf), periods(spark, sf), "k", "ts", "st", "fi", ["period_id"], ["period_id"], width="30 days"
    )
    found = F.col("match")
    return joined.select(
        "l_orderkey", "l_linenumber", "k", "ts", found["period_id"].alias("period_id"), found["st"].alias("st")
    )


@query(
    "asof_backward_join",
    """WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
       p AS (SELECT user_id, ts AS rst FROM events WHERE event_type <> 'error')
       SELECT event_id, e.user_id, COALESCE(rst, ts) AS ts, ts AS origin_ts,
              COALESCE(date_diff('microsecond', rst, ts) / 1000000.0, 0.0) AS delta_sec
       FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND p.rst < e.ts""",
)
def asof_backward_join(spark, sf):
    events = Tables(spark, sf).events
    bad = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    made = events.filter("event_type <> 'error'").select("user_id", F.col("ts").alias("rst"))
    return temporal.asof_backward_join(bad, made, "user_id", "ts", "rst")


@query(
    "lagged_interval_probe",
    """WITH r AS (SELECT user_id, event_id AS so_id, ts AS st, ts + to_minutes(CAST(10 + event_id % 50 AS INTEGER)) AS fi FROM events WHERE event_type = 'signup'),
       d AS (SELECT user_id, ts - to_hours(CAST(h AS INTEGER)) AS t FROM events, (SELECT unnest([1, 2, 3]) AS h) WHERE event_type = 'error')
       SELECT DISTINCT so_id FROM r JOIN d ON r.user_id = d.user_id AND d.t BETWEEN r.st AND r.fi""",
)
def lagged_interval_probe(spark, sf):
    events = Tables(spark, sf).events
    length = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 50 + 10).cast("int"))
    runs = events.filter("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("so_id"), F.col("ts").alias("st"), (F.col("ts") + length).alias("fi")
    )
    bad = events.filter("event_type = 'error'").select("user_id", "ts")
    return temporal.lagged_interval_probe(bad, runs, "user_id", "ts", "st", "fi", ["1 hour", "2 hours", "3 hours"], "so_id")


@query(
    "lookback_interval_join",
    """WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), s AS (SELECT user_id, ts AS mt, value FROM events)
       SELECT event_id, e.ts, count(mt) AS n_readings, COALESCE(string_agg(CAST(value AS VARCHAR), ',' ORDER BY mt, value), '') AS readings
       FROM e LEFT JOIN s ON e.user_id = s.user_id AND mt BETWEEN ts - INTERVAL 7 HOUR AND ts GROUP BY event_id, e.ts""",
)
def lookback_interval_join(spark, sf):
    events = Tables(spark, sf).events
    bad = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    series = events.select("user_id", F.col("ts").alias("mt"), "value")
    joined = temporal.lookback_interval_join(bad, series, "user_id", "event_id", "ts", "mt", "value", "7 hours")
    text = F.array_join(F.transform("readings", lambda r: r["value"].cast("string")), ",")
    return joined.select(
        "event_id", "ts", F.size("readings").cast("long").alias("n_readings"), text.alias("readings")
    )


@query(
    "sensor_window_stats",
    """WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), s AS (SELECT user_id, ts AS mt, value FROM events WHERE event_type = 'view')
       SELECT event_id, count(mt) AS reading_count, round(avg(value), 8) AS reading_avg, min(value) AS reading_min, max(value) AS reading_max
       FROM e LEFT JOIN s ON e.user_id = s.user_id AND mt BETWEEN ts - INTERVAL 7 HOUR AND ts GROUP BY event_id""",
)
def sensor_window_stats(spark, sf):
    events = Tables(spark, sf).events
    bad = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    series = events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("mt"), "value")
    stats = temporal.lookback_stats(bad, series, "user_id", "event_id", "ts", "mt", "value", "7 hours")
    return stats.select(
        "event_id", "reading_count", F.round("reading_avg", 8).alias("reading_avg"), "reading_min", "reading_max"
    )


CYCLES_SQL = """SELECT user_id, ts AS st, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS en FROM events WHERE event_type = 'signup'"""


@query(
    "cycle_window_join",
    f"""SELECT c.user_id, c.st, c.en, e.event_id FROM ({CYCLES_SQL}) c JOIN events e ON e.user_id = c.user_id AND e.ts BETWEEN c.st AND c.en
        WHERE c.en IS NOT NULL""",
)
def cycle_window_join(spark, sf):
    from millstream.operators import chunked

    events = Tables(spark, sf).events
    marks = events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("st"), F.col("event_id").alias("mark_id"))
    marks = chunked.with_time_chunk(marks, "st", "1 day")
    cycles = chunked.following(marks, "user_id", ["st", "mark_id"], ["st"], "nxt")
    cycles = cycles.select("user_id", "st", F.col("nxt.st").alias("en")).filter("en is not null")
    series = events.select("user_id", "ts", "event_id")
    return temporal.cycle_window_join(series, cycles, "user_id", "ts", "st", "en", bucket="6 hours").select(
        "user_id", "st", "en", "event_id"
    )


@query(
    "wo_period_join",
    """WITH w AS (SELECT s_nationkey AS zone, o_orderkey % 7 AS part_cd, CAST(o_orderdate AS DATE) AS cur FROM orders
                  JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
       o AS (SELECT zone, part_cd, cur, lag(cur) OVER (PARTITION BY zone, part_cd ORDER BY cur) AS prev FROM w),
       q AS (SELECT s_nationkey AS zone, CAST(l_shipdate AS DATE) AS ymd, sum(l_quantity) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
       SELECT zone, part_cd, strftime(cur, '%Y%m%d') AS cur, strftime(prev, '%Y%m%d') AS prev,
              CAST(COALESCE(sum(CASE WHEN ymd >= prev AND ymd <= cur THEN qty END), 0) AS DOUBLE) AS total_qty,
              CAST(COALESCE(sum(CASE WHEN ymd > cur THEN qty END), 0) AS DOUBLE) AS total_qty_recent
       FROM o LEFT JOIN q USING (zone) GROUP BY zone, part_cd, cur, prev""",
)
def wo_period_join(spark, sf):
    t = Tables(spark, sf)
    zones = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as zone")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate").join(zones, "l_suppkey")
    days = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("cur"))
    orders = lines.join(days, "l_orderkey")
    orders = orders.select("zone", (F.col("l_orderkey") % 7).alias("part_cd"), "cur", "l_orderkey", "l_linenumber")
    gaps = temporal.lag_gap_days(orders, ["zone", "part_cd"], "cur", ["l_orderkey", "l_linenumber"])
    gaps = gaps.select("zone", "part_cd", "cur", F.col("previous_day").alias("prev"))
    made = lines.select("zone", F.col("l_shipdate").cast("date").alias("ymd"), F.col("l_quantity").alias("qty"))
    joined = joins.wo_period_join(gaps, made, "zone", "prev", "cur", "ymd", "qty")
    return joined.select(
        "zone", "part_cd", F.date_format("cur", "yyyyMMdd").alias("cur"), F.date_format("prev", "yyyyMMdd").alias("prev"),
        F.col("total_qty").cast("double").alias("total_qty"), F.col("total_qty_recent").cast("double").alias("total_qty_recent"),
    )


@query(
    "semi_exists",
    """SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
       AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O')""",
)
def semi_exists(spark, sf):
    t = Tables(spark, sf)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus")
    conditions = [F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"]
    return joins.semi_exists(t.orders.select("o_orderkey"), lines, "o_orderkey", conditions)


@query("semi_by_keys", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def semi_by_keys(spark, sf):
    t = Tables(spark, sf)
    matched = t.lineitem.filter("l_quantity >= 50").selectExpr("l_orderkey as o_orderkey")
    return joins.semi_by_keys(t.orders.select("o_orderkey", "o_totalprice"), matched, "o_orderkey")


@query(
    "anti_join_null_safe",
    """WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS so_id FROM lineitem)
       SELECT l_orderkey, l_linenumber, so_id FROM g WHERE so_id IS NULL OR so_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def anti_join_null_safe(spark, sf):
    t = Tables(spark, sf)
    so_id = F.when(F.col("l_returnflag") != "N", F.col("l_orderkey"))
    products = t.lineitem.select("l_orderkey", "l_linenumber", so_id.alias("so_id"))
    bad = t.orders.filter("o_orderstatus = 'F'").selectExpr("o_orderkey as so_id")
    return joins.anti_join_null_safe(products, bad, "so_id").select("l_orderkey", "l_linenumber", "so_id")


@query(
    "tuple_in_max",
    """SELECT o_custkey, o_orderpriority, o_orderkey, year(o_orderdate) AS seq FROM orders WHERE (o_custkey, o_orderpriority, year(o_orderdate)) IN (
         SELECT (o_custkey, o_orderpriority, max(year(o_orderdate))) FROM orders GROUP BY o_custkey, o_orderpriority)""",
)
def tuple_in_max(spark, sf):
    steps = Tables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderkey", F.year("o_orderdate").cast("long").alias("seq"))
    return joins.tuple_in_max(steps, ["o_custkey", "o_orderpriority"], "seq")


@query(
    "join_to_max_per_group",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem JOIN (
         SELECT l_suppkey AS k, max(l_shipdate) AS m FROM lineitem GROUP BY l_suppkey) ON l_suppkey = k AND l_shipdate = m""",
)
def join_to_max_per_group(spark, sf):
    lines = Tables(spark, sf).lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return joins.join_to_max_per_group(lines, "l_suppkey", "l_shipdate")


CHECK_SQL = """SELECT o_orderkey AS id, o_custkey % 10 AS a1, o_orderstatus AS a2, CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE 'x' END AS a3,
   l_suppkey % 10 AS b1, CASE l_linestatus WHEN 'O' THEN 'O' ELSE 'F' END AS b2, CASE WHEN l_returnflag = 'N' THEN 'y' ELSE 'x' END AS b3
   FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


def checked(spark, sf):
    t = Tables(spark, sf)
    a = t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 10).alias("machine"), F.col("o_orderstatus").alias("station"),
        F.when(~F.col("o_orderpriority").startswith("1"), "x").alias("side"),
    )
    b = t.lineitem.select(
        F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 10).alias("mc"),
        F.when(F.col("l_linestatus") == "O", "O").otherwise("F").alias("st"),
        F.when(F.col("l_returnflag") == "N", "y").otherwise("x").alias("lr"),
    )
    return joins.cross_check_join(a, b, "id", {"machine": ("machine", "mc"), "station": ("station", "st"), "side": ("side", "lr")})


@query(
    "cross_check_join",
    f"""SELECT id, a1 = b1 AS machine_match, a2 = b2 AS station_match, COALESCE(a3 = b3, false) AS side_match,
          COALESCE(a1 = b1 AND a2 = b2 AND a3 = b3, false) AS all_match, a3 IS NOT NULL AS valid_comparison FROM ({CHECK_SQL})""",
)
def cross_check_join(spark, sf):
    return checked(spark, sf).select("id", "machine_match", "station_match", "side_match", "all_match", "valid_comparison")


@query(
    "match_statistics",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (a3 IS NOT NULL) AS n_valid,
          count(*) FILTER (a3 IS NOT NULL AND a1 = b1 AND a2 = b2 AND a3 = b3) AS n_match,
          round(count(*) FILTER (a3 IS NOT NULL AND a1 = b1 AND a2 = b2 AND a3 = b3) * 100.0 / count(*) FILTER (a3 IS NOT NULL), 2) AS match_pct
        FROM ({CHECK_SQL})""",
)
def match_statistics(spark, sf):
    return joins.match_statistics(checked(spark, sf))


@query(
    "self_join_hierarchy",
    """SELECT s_suppkey, s_name AS line_name, n_name AS building_name, r_name AS factory_name
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def self_join_hierarchy(spark, sf):
    t = Tables(spark, sf)
    loc = (
        t.supplier.select(F.concat(F.lit("L"), "s_suppkey").alias("id"), F.concat(F.lit("B"), "s_nationkey").alias("up"), F.col("s_name").alias("nm"))
        .union(t.nation.select(F.concat(F.lit("B"), "n_nationkey"), F.concat(F.lit("F"), "n_regionkey"), F.col("n_name")))
        .union(t.region.select(F.concat(F.lit("F"), "r_regionkey"), F.lit(None).cast("string"), F.col("r_name")))
    )
    fact = t.supplier.select("s_suppkey", F.concat(F.lit("L"), "s_suppkey").alias("line_id"))
    named = joins.self_join_hierarchy(fact, loc, "line_id", "id", "up", "nm", ["line", "building", "factory"])
    return named.drop("line_id")


@query(
    "wildcard_match_join",
    """WITH a AS (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS sensor, event_type AS factory, user_id % 3 AS building, event_id % 4 AS floor FROM events),
       s AS (SELECT n_nationkey AS sub_id, CASE WHEN n_nationkey % 8 = 7 THEN n_nationkey END AS sensor,
               CASE n_nationkey % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'click' END AS factory, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 3 END AS building,
               CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey % 4 END AS floor FROM nation)
       SELECT event_id, sub_id FROM a JOIN s ON (a.sensor IS NOT NULL AND s.sensor = a.sensor)
          OR ((s.sensor IS NULL OR a.sensor IS NULL) AND (s.factory IS NULL OR s.factory = a.factory)
              AND (s.building IS NULL OR s.building = a.building) AND (s.floor IS NULL OR s.floor = a.floor))""",
)
def wildcard_match_join(spark, sf):
    t = Tables(spark, sf)
    alerts = t.events.select(
        "event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("sensor"), F.col("event_type").alias("factory"),
        (F.col("user_id") % 3).alias("building"), (F.col("event_id") % 4).alias("floor"),
    )
    n = F.col("n_nationkey").cast("long")
    subs = t.nation.select(
        F.col("n_nationkey").alias("sub_id"), F.when(n % 8 == 7, n).alias("sensor"),
        F.when(n % 3 == 0, "error").when(n % 3 == 1, "click").alias("factory"),
        F.when(n % 2 == 0, n % 3).alias("building"), F.when(n % 5 == 0, n % 4).alias("floor"),
    )
    return joins.wildcard_match_join(alerts, subs, "event_id", "sub_id", "sensor", ["factory", "building", "floor"])


@query(
    "effective_dated_join",
    """WITH m AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE make_date(1995 + CAST(s_suppkey % 5 AS INTEGER), 6, 1) END AS vf,
                        CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE make_date(1999 + CAST(s_suppkey % 4 AS INTEGER), 1, 1) END AS vt FROM supplier)
       SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN m ON l_suppkey = s_suppkey WHERE (vf IS NULL OR vf <= l_shipdate) AND (vt IS NULL OR vt >= l_shipdate)""",
)
def effective_dated_join(spark, sf):
    t = Tables(spark, sf)
    key = F.col("s_suppkey")
    mapping = t.supplier.select(
        key.alias("l_suppkey"),
        F.when(key % 4 != 0, F.make_date((key % 5 + 1995).cast("int"), F.lit(6), F.lit(1))).cast("timestamp_ntz").alias("vf"),
        F.when(key % 3 != 0, F.make_date((key % 4 + 1999).cast("int"), F.lit(1), F.lit(1))).cast("timestamp_ntz").alias("vt"),
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    joined = joins.effective_dated_join(lines, mapping, "l_suppkey", "l_shipdate", "vf", "vt")
    return joined.select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "worksheet_detail_join",
    """WITH pl AS (SELECT o_custkey AS ws, o_orderpriority AS op, o_orderkey, year(o_orderdate) AS seq FROM orders
                   QUALIFY rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY year(o_orderdate) DESC) = 1),
       sc AS (SELECT o_custkey AS ws, o_orderpriority AS op, l_returnflag AS st, l_quantity AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority, l_returnflag ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_quantity) = 1),
       bm AS (SELECT c_custkey AS ws, c_mktsegment AS model FROM customer)
       SELECT ws, op, o_orderkey, st, qty, model FROM pl LEFT JOIN sc USING (ws, op) LEFT JOIN bm USING (ws)""",
)
def worksheet_detail_join(spark, sf):
    t = Tables(spark, sf)
    sheet = t.orders.select(F.col("o_custkey").alias("ws"), F.col("o_orderpriority").alias("op"), "o_orderkey", F.year("o_orderdate").alias("seq"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", F.col("l_returnflag").alias("st"), F.col("l_quantity").alias("qty"))
    scans = lines.join(sheet.select("ws", "op", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    bom = t.customer.select(F.col("c_custkey").alias("ws"), F.col("c_mktsegment").alias("model"))
    joined = joins.worksheet_detail_join(
        sheet, scans, bom, ["ws", "op"], "seq", "st", [F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("qty")],
        ["ws"], [F.col("model")],
    )
    return joined.select("ws", "op", "o_orderkey", "st", "qty", "model")


@query(
    "orphan_check",
    "SELECT count(*) AS orphans FROM events LEFT JOIN customer ON user_id = CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END WHERE c_custkey IS NULL",
)
def orphan_check(spark, sf):
    t = Tables(spark, sf)
    known = t.customer.selectExpr("if(c_acctbal > 0, c_custkey, -c_custkey) as user_id")
    return joins.orphan_check(t.events.select("user_id"), known, "user_id")


@query(
    "not_in_use_devices",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R')",
)
def not_in_use_devices(spark, sf):
    t = Tables(spark, sf)
    used = t.lineitem.filter("l_quantity = 50 and l_returnflag = 'R'").selectExpr("l_suppkey as s_suppkey")
    return joins.not_in_use_devices(t.supplier.select("s_suppkey", "s_name"), used, "s_suppkey")


@query(
    "dict_lookup_merge",
    """WITH p AS (SELECT o_custkey AS k, count(*) AS plan_cnt, sum(o_totalprice) AS plan_qty FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1),
       r AS (SELECT o_custkey AS k, count(*) AS prod_cnt, sum(o_totalprice) AS prod_qty FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
       SELECT c_custkey AS k, COALESCE(plan_cnt, 0) AS plan_cnt, round(COALESCE(plan_qty, 0), 2) AS plan_qty, COALESCE(prod_cnt, 0) AS prod_cnt,
              round(COALESCE(prod_qty, 0), 2) AS prod_qty, CASE WHEN plan_qty > 0 THEN round(COALESCE(prod_qty, 0) / plan_qty * 100, 2) ELSE 0.0 END AS rate
       FROM customer LEFT JOIN p ON p.k = c_custkey LEFT JOIN r ON r.k = c_custkey""",
)
def dict_lookup_merge(spark, sf):
    t = Tables(spark, sf)

    def summed(df, name):
        return df.groupBy(F.col("o_custkey").alias("k")).agg(
            F.count(F.lit(1)).alias(f"{name}_cnt"), F.sum("o_totalprice").alias(f"{name}_qty")
        )

    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    plan = summed(t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & early), "plan")
    prod = summed(t.orders.filter("o_orderstatus = 'F'"), "prod")
    master = t.customer.selectExpr("c_custkey as k")
    merged = joins.dict_lookup_merge(
        master, plan, prod, "k", ["plan_cnt", "plan_qty", "prod_cnt", "prod_qty"], "plan_qty", "prod_qty"
    )
    return merged.withColumns({q: F.round(q, 2) for q in ("plan_qty", "prod_qty")})


@query(
    "sensor_location_enrich",
    """SELECT event_id, c_nationkey, n_name, n_regionkey FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2""",
)
def sensor_location_enrich(spark, sf):
    t = Tables(spark, sf)
    sensors = t.customer.selectExpr("c_custkey as user_id", "c_nationkey")
    locations = t.nation.selectExpr("n_nationkey as c_nationkey", "n_name", "n_regionkey")
    rows = joins.sensor_location_enrich(
        t.events.select("event_id", "user_id"), sensors, locations, "user_id", "c_nationkey", F.col("n_regionkey") == 2
    )
    return rows.select("event_id", "c_nationkey", "n_name", "n_regionkey")


# Quality chain: mount periods trimmed, defects matched to their period, checked against the correction to the
# last production time, and enriched with the readings before it.
@query(
    "defect_quality_chain",
    """WITH iv AS (SELECT user_id, event_id AS mount_id, ts AS st, least(COALESCE(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '2024-02-01'), ts + INTERVAL 12 HOUR) AS fi
                   FROM events WHERE event_type = 'signup'),
       d AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
       m AS (SELECT event_id, d.user_id, ts, min(mount_id) AS mount_id FROM d JOIN iv ON d.user_id = iv.user_id AND ts BETWEEN st AND fi GROUP BY ALL),
       p AS (SELECT user_id, ts AS rst FROM events WHERE event_type = 'purchase'),
       a AS (SELECT event_id, m.user_id, mount_id, COALESCE(rst, ts) AS ts FROM m ASOF LEFT JOIN p ON m.user_id = p.user_id AND p.rst < m.ts),
       s AS (SELECT user_id, ts AS mt, value FROM events WHERE event_type IN ('view', 'click'))
       SELECT event_id, mount_id, ts, count(mt) AS reading_count, max(value) AS reading_max FROM a LEFT JOIN s ON a.user_id = s.user_id AND mt BETWEEN ts - INTERVAL 5 HOUR AND ts
       GROUP BY event_id, mount_id, ts""",
)
def defect_quality_chain(spark, sf):
    events = Tables(spark, sf).events
    mounts = events.filter("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("mount_id"), F.col("ts").alias("st"), (F.col("ts") + interval("12 hours")).alias("fi")
    )
    mounts = temporal.overlap_trim(mounts, "user_id", "st", "fi", tiebreak=["mount_id"])
    bad = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    matched = temporal.interval_join_first(bad, mounts, "user_id", "ts", "st", "fi", ["mount_id"], ["mount_id"])
    matched = matched.withColumn("mount_id", F.col("match.mount_id")).filter("mount_id is not null").drop("match")
    made = events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("rst"))
    corrected = temporal.asof_backward_join(matched, made, "user_id", "ts", "rst").drop("origin_ts", "delta_sec")
    series = events.filter("event_type in ('view', 'click')").select("user_id", F.col("ts").alias("mt"), "value")
    stats = temporal.lookback_stats(corrected, series, "user_id", "event_id", "ts", "mt", "value", "5 hours")
    return stats.select("event_id", "mount_id", "ts", "reading_count", "reading_max")


@query(
    "good_product_filter",
    """WITH r AS (SELECT user_id, event_id AS so_id, ts AS st, ts + to_minutes(CAST(10 + event_id % 50 AS INTEGER)) AS fi FROM events WHERE event_type = 'signup'),
       d AS (SELECT user_id, ts - to_hours(CAST(h AS INTEGER)) AS t FROM events, (SELECT unnest([1, 2, 3]) AS h) WHERE event_type = 'error')
       SELECT so_id, st FROM r WHERE so_id NOT IN (SELECT so_id FROM r JOIN d ON r.user_id = d.user_id AND d.t BETWEEN r.st AND r.fi)""",
)
def good_product_filter(spark, sf):
    events = Tables(spark, sf).events
    length = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 50 + 10).cast("int"))
    runs = events.filter("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("so_id"), F.col("ts").alias("st"), (F.col("ts") + length).alias("fi")
    )
    bad = events.filter("event_type = 'error'").select("user_id", "ts")
    offsets = ["1 hour", "2 hours", "3 hours"]
    hit = temporal.lagged_interval_probe(bad, runs, "user_id", "ts", "st", "fi", offsets, "so_id")
    return joins.anti_join_null_safe(runs.select("so_id", "st"), hit, "so_id")
