"""Aggregations and marts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.functions import cleaning as c
from millstream.functions import timekeys as tk
from millstream.operators import aggregates as a
from millstream.operators import joins, marts, quantiles, sequences, temporal
from millstream.plans.registry import Tables, query
from millstream.session import shared_path
from millstream.sources import snapshots, writers

R = 6  # digits that survive summation in another order


@query(
    "hourly_sensor_stats",
    """SELECT strftime(ts, '%Y%m%d') AS ymd, CAST(hour(ts) AS INTEGER) AS hour, user_id, round(max(value), 2) AS value_max, round(min(value), 2) AS value_min,
              CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / count(value) + 0.5) / 100 AS DOUBLE) AS value_avg FROM events WHERE event_type <> 'error' GROUP BY 1, 2, 3""",
)
def hourly_sensor_stats(spark, sf):
    raw = Tables(spark, sf).events.select("ts", "user_id", F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise(" ").alias("value"))
    stats = a.hourly_sensor_stats(raw, "user_id", "ts", ["value"])
    path = shared_path(spark, "hourly")
    writers.upsert(spark, path, stats, ["ymd", "hour", "user_id"], [F.col("value_max").desc()], ["ymd"])
    return snapshots.read(spark, path).select("ymd", "hour", "user_id", "value_max", "value_min", "value_avg")


@query(
    "rollup_grouping_filter",
    """WITH b AS (SELECT l_suppkey % 20 AS mc, p_brand AS nm, p_type AS color, count(*) AS plan_qty, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS rst_qty
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
       SELECT COALESCE(CAST(mc AS VARCHAR), 'Total') AS machine_no, CAST(sum(plan_qty) AS BIGINT) AS plan_qty, CAST(sum(rst_qty) AS BIGINT) AS rst_qty FROM b
       GROUP BY ROLLUP (mc, nm, color) HAVING grouping(nm) = 1 AND grouping(color) = 1""",
)
def rollup_grouping_filter(spark, sf):
    t = Tables(spark, sf)
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("nm"), F.col("p_type").alias("color"))
    lots = t.lineitem.select("l_partkey", (F.col("l_suppkey") % 20).alias("mc"), "l_linestatus").join(parts, "l_partkey")
    measures = {"plan_qty": F.count(F.lit(1)), "rst_qty": F.count_if(F.col("l_linestatus") == "F")}
    return a.rollup_grouping_filter(lots, ["mc", "nm", "color"], 1, measures, "machine_no")


@query(
    "conditional_pivot_sum",
    """SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS s1_qty, round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END), 2) AS s1_price,
              sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS s2_qty, round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END), 2) AS s2_price,
              sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS s3_qty, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS s3_price
       FROM lineitem GROUP BY l_suppkey""",
)
def conditional_pivot_sum(spark, sf):
    lines = Tables(spark, sf).lineitem.withColumnsRenamed({"l_quantity": "qty", "l_extendedprice": "price"})
    wide = a.conditional_pivot_sum(lines, "l_suppkey", "l_returnflag", {"A": "s1", "N": "s2", "R": "s3"}, ["qty", "price"])
    return wide.withColumns({f"s{i}_price": F.round(f"s{i}_price", 2) for i in (1, 2, 3)})


TYPES = {"view": "view", "click": "click", "purchase": "purchase", "signup": "signup", "error": "error"}


@query(
    "pivot_first",
    """SELECT user_id, date_trunc('hour', ts) AS hour_ts, """
    + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{e}') AS {e}" for e in TYPES)
    + " FROM events GROUP BY 1, 2",
)
def pivot_first(spark, sf):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    events = Tables(spark, sf).events.withColumn("hour_ts", hour)
    return a.pivot_first(events, ["user_id", "hour_ts"], "event_type", "value", TYPES, "event_id")


@query(
    "pivot_count",
    """SELECT p_brand, count(*) FILTER (p_type = 'ECONOMY') AS n_ECONOMY, count(*) FILTER (p_type = 'STANDARD') AS n_STANDARD FROM part GROUP BY p_brand""",
)
def pivot_count(spark, sf):
    return a.pivot_count(Tables(spark, sf).part, "p_brand", "p_type", ["ECONOMY", "STANDARD"], "n_")


@query(
    "pivot_agg",
    """SELECT l_suppkey, max(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS A_max, max(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS R_max FROM lineitem GROUP BY l_suppkey""",
)
def pivot_agg(spark, sf):
    return a.pivot_agg(Tables(spark, sf).lineitem, "l_suppkey", "l_returnflag", ["A", "R"], F.max, "l_quantity", suffix="_max", otherwise=0.0)


@query(
    "unpivot",
    """SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
       UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""",
)
def unpivot(spark, sf):
    return a.unpivot(Tables(spark, sf).part, "p_partkey", ["p_brand", "p_type", "p_size"], "prop", "val")


@query(
    "tumbling_10min_avg",
    """SELECT event_type, time_bucket(INTERVAL 10 MINUTE, ts + INTERVAL 2 HOUR) AS bucket_ts, CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / count(value) + 0.5) / 100 AS DOUBLE) AS value_avg FROM events GROUP BY 1, 2""",
)
def tumbling_10min_avg(spark, sf):
    return a.tumbling_avg(Tables(spark, sf).events, "event_type", "ts", ["value"], "10 minutes", "Asia/Jakarta", "Asia/Seoul")


SUFFIX = 12  # digits of a sensor number in these queries, enough for any id


def hourly_by_location(spark, sf, start_key, end_key):
    """Hourly rows of numbered sensors from the days of two keys, and one location per sensor suffix.

    The range is tested on the time itself, before the aggregation, so that the scan can use it.
    """
    t = Tables(spark, sf)
    events = t.events.filter((F.col("ts") >= tk.date_key_range(F.lit(start_key))[0]) & (F.col("ts") < tk.date_key_range(F.lit(end_key))[1]))
    sensor = F.concat(F.lit("SENSOR-"), F.lpad(F.col("user_id").cast("string"), SUFFIX, "0"))
    hourly = a.hourly_sensor_stats(events.withColumn("sensor_id", sensor), "sensor_id", "ts", ["value"])
    key = F.lpad(F.col("c_custkey").cast("string"), SUFFIX, "0")
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey").join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    locations = t.customer.join(nations, "c_nationkey").select(
        key.alias("loc_id"), F.col("r_name").alias("factory"), F.col("n_name").alias("building"),
        (F.col("c_custkey") % 3).cast("int").alias("floor"), F.col("c_mktsegment").alias("area"),
    )
    return hourly, locations


HOURLY_SQL = """h AS (SELECT strftime(ts, '%Y%m%d') AS ymd, CAST(hour(ts) AS INTEGER) AS hour, user_id, round(max(value), 2) AS mx, round(min(value), 2) AS mn, CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / count(value) + 0.5) / 100 AS DOUBLE) AS av FROM events GROUP BY 1, 2, 3),
 l AS (SELECT c_custkey, r_name AS factory, n_name AS building, CAST(c_custkey % 3 AS INTEGER) AS floor FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "multi_level_time_agg",
    f"""WITH {HOURLY_SQL} SELECT ymd, '00' AS hour, factory, building, max(mx) AS value_max, min(mn) AS value_min, CAST(floor(sum(CAST(round(av * 100) AS BIGINT)) / count(av) + 0.5) / 100 AS DOUBLE) AS value_avg
        FROM h JOIN l ON user_id = c_custkey WHERE factory = 'ASIA' AND building = 'NATION_12' AND substr(ymd, 1, 6) BETWEEN '202401' AND '202402' GROUP BY 1, 3, 4""",
)
def multi_level_time_agg(spark, sf):
    hourly, locations = hourly_by_location(spark, sf, "202401", "202402")
    return a.multi_level_time_agg(hourly, locations, "202401", "202402", ["value"], factory="ASIA", building="NATION_12", suffix=SUFFIX)


@query(
    "multi_level_hourly_floor",
    f"""WITH {HOURLY_SQL} SELECT ymd, lpad(CAST(hour AS VARCHAR), 2, '0') AS hour, factory, building, floor, max(mx) AS value_max, min(mn) AS value_min, CAST(floor(sum(CAST(round(av * 100) AS BIGINT)) / count(av) + 0.5) / 100 AS DOUBLE) AS value_avg
        FROM h JOIN l ON user_id = c_custkey WHERE factory = 'AFRICA' AND building = 'NATION_5' AND floor = 1 AND ymd BETWEEN '20240105' AND '20240125' AND hour BETWEEN 6 AND 18 GROUP BY ALL""",
)
def multi_level_hourly_floor(spark, sf):
    hourly, locations = hourly_by_location(spark, sf, "20240105", "20240125")
    return a.multi_level_time_agg(
        hourly, locations, "20240105", "20240125", ["value"], factory="AFRICA", building="NATION_5", floor=1,
        start_hour=6, end_hour=18, suffix=SUFFIX,
    )


@query("hour_fallback_check", "SELECT event_id FROM events WHERE hour(ts) BETWEEN 6 AND 9 UNION ALL SELECT event_id FROM events")
def hour_fallback_check(spark, sf):
    events = Tables(spark, sf).events.select("event_id", F.hour("ts").alias("hour"))
    found = a.hour_fallback_check(events, "hour", 6, 9)
    missing = a.hour_fallback_check(events, "hour", 24, 30)
    return found.select("event_id").union(missing.select("event_id"))


@query(
    "plan_prod_defect_mart",
    """WITH x AS (SELECT CASE p_size % 4 WHEN 0 THEN 'IPI' WHEN 1 THEN 'OSP' WHEN 2 THEN 'PHH' ELSE 'PHM' END AS op_cd, strftime(l_shipdate, '%Y-%m') AS month, l_quantity AS q, l_returnflag AS f
                  FROM lineitem JOIN part ON l_partkey = p_partkey)
       SELECT op_cd, CASE op_cd WHEN 'IPI' THEN 'IP' WHEN 'OSP' THEN 'OS' ELSE 'PH' END AS op_group, month, sum(q) AS plan_qty, COALESCE(sum(q) FILTER (f <> 'N'), 0) AS prod_qty, COALESCE(sum(q) FILTER (f = 'R'), 0) AS defect_qty,
              round(COALESCE((COALESCE(sum(q) FILTER (f <> 'N'), 0) - COALESCE(sum(q) FILTER (f = 'R'), 0)) * 100 / sum(q) FILTER (f <> 'N'), 0), 2) AS quality_rate,
              round(COALESCE(sum(q) FILTER (f <> 'N'), 0) * 100 / sum(q), 2) AS achievement_rate
       FROM x GROUP BY 1, 2, 3""",
)
def plan_prod_defect_mart(spark, sf):
    t = Tables(spark, sf)
    op = F.element_at(F.array(*[F.lit(o) for o in ("IPI", "OSP", "PHH", "PHM")]), F.col("p_size") % 4 + 1)
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), op.alias("op_cd"))
    lines = t.lineitem.select("l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_quantity").alias("q"), "l_returnflag").join(parts, "l_partkey")
    made, bad = lines.filter("l_returnflag <> 'N'"), lines.filter("l_returnflag = 'R'")
    mart = marts.plan_prod_defect_mart((lines, "q"), (made, "q"), (bad, "q"), ["op_cd", "month"])
    return mart.withColumn("op_group", marts.op_group("op_cd"))


@query(
    "shift_slice_mart",
    """WITH x AS (SELECT user_id, event_type, ts, value FROM events),
       p AS (SELECT user_id, sum(value) AS q FROM x WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-10 14:30:00' AND ts < TIMESTAMP '2024-01-10 22:30:00' GROUP BY 1),
       r AS (SELECT user_id, sum(value) AS q FROM x WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10 14:30:00' AND ts + INTERVAL 30 MINUTE < TIMESTAMP '2024-01-10 22:30:00' GROUP BY 1),
       d AS (SELECT user_id, sum(value) AS q FROM x WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY 1)
       SELECT COALESCE(p.user_id, r.user_id, d.user_id) AS user_id, round(COALESCE(p.q, 0), 4) AS plan_qty, round(COALESCE(r.q, 0), 4) AS prod_qty, round(COALESCE(d.q, 0), 4) AS defect_qty
       FROM p FULL JOIN r ON p.user_id = r.user_id FULL JOIN d ON COALESCE(p.user_id, r.user_id) = d.user_id""",
)
def shift_slice_mart(spark, sf):
    events = Tables(spark, sf).events.withColumn("end_ts", F.col("ts") + tk.interval("30 minutes"))
    start, end, _ = tk.shift_window(tk.as_ntz("2024-01-10 16:00:00"))
    of = {k: events.filter(F.col("event_type") == k) for k in ("view", "purchase", "error")}
    mart = marts.shift_slice_mart(
        of["view"], of["purchase"], of["error"], ["user_id"], start, end, "ts", "ts", "end_ts", "ts", "value"
    )
    return mart.select("user_id", *[F.round(q, 4).alias(q) for q in ("plan_qty", "prod_qty", "defect_qty")])


@query(
    "downtime_mart",
    """WITH v AS (SELECT s_nationkey AS line_cd, strftime(l_shipdate, '%Y%m') AS month, sum(l_quantity * 10) AS down_time_value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
       t AS (SELECT s_nationkey AS line_cd, strftime(l_shipdate, '%Y%m') AS month, count(*) * 30.0 AS down_time_target FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
       SELECT COALESCE(v.line_cd, t.line_cd) AS line_cd, COALESCE(v.month, t.month) AS month, CAST(COALESCE(down_time_value, 0) AS DOUBLE) AS down_time_value, CAST(COALESCE(down_time_target, 0) AS DOUBLE) AS down_time_target
       FROM v FULL JOIN t ON v.line_cd = t.line_cd AND v.month = t.month""",
)
def downtime_mart(spark, sf):
    t = Tables(spark, sf)
    lines = t.lineitem.join(t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as line_cd"), "l_suppkey")
    lines = lines.withColumn("month", F.date_format("l_shipdate", "yyyyMM"))
    targets = lines.groupBy("line_cd", "month").agg((F.count(F.lit(1)) * 30.0).alias("down_time_target"))
    return marts.downtime_mart(lines, targets, ["line_cd", "month"], F.col("l_returnflag") == "R", F.col("l_quantity") * 10)


@query("wo_status_counts", "SELECT r_name, n_name, o_orderstatus, count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3")
def wo_status_counts(spark, sf):
    return a.status_counts(order_places(spark, sf), ["r_name", "n_name", "o_orderstatus"])


def order_places(spark, sf):
    t = Tables(spark, sf)
    nations = t.nation.withColumnRenamed("n_regionkey", "r_regionkey").join(t.region, "r_regionkey")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return t.orders.select("o_custkey", "o_orderstatus").join(customers, "o_custkey").join(nations, "n_nationkey")


@query(
    "grouping_sets_wo",
    """SELECT CASE grouping_id(c_mktsegment, n_name, r_name, o_orderstatus) WHEN 6 THEN 'c_mktsegment/o_orderstatus' WHEN 10 THEN 'n_name/o_orderstatus' WHEN 12 THEN 'r_name/o_orderstatus' ELSE 'o_orderstatus' END AS level,
              c_mktsegment, n_name, r_name, o_orderstatus, count(*) AS cnt
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY GROUPING SETS ((c_mktsegment, o_orderstatus), (n_name, o_orderstatus), (r_name, o_orderstatus), (o_orderstatus))""",
)
def grouping_sets_wo(spark, sf):
    sets = [["c_mktsegment", "o_orderstatus"], ["n_name", "o_orderstatus"], ["r_name", "o_orderstatus"], ["o_orderstatus"]]
    return a.grouping_sets_counts(order_places(spark, sf), sets)


@query(
    "nested_hierarchy",
    """WITH x AS (SELECT DISTINCT r_name, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
       n AS (SELECT r_name, n_name, n_name || '[' || string_agg(s_name, ',' ORDER BY s_name) || ']' AS t FROM x GROUP BY 1, 2)
       SELECT r_name, string_agg(t, ';' ORDER BY n_name) AS tree FROM n GROUP BY r_name""",
)
def nested_hierarchy(spark, sf):
    t = Tables(spark, sf)
    rows = t.supplier.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    tree = a.nested_hierarchy(rows, ["r_name", "n_name"], ["s_name"])
    leaf = F.array_join(F.transform
                        ("children", lambda n: F.concat(n["name"], F.lit("["), F.array_join(F.transform(n["children"], lambda s: s["s_name"]), ","), F.lit("]"))), ";")
    return tree.select("r_name", leaf.alias("tree"))


@query(
    "nested_readings",
    """SELECT user_id, strftime(ts, '%Y%m%d') AS ymd, count(*) AS n, string_agg(CAST(value AS VARCHAR), ',' ORDER BY ts, event_id) AS items FROM events GROUP BY 1, 2""",
)
def nested_readings(spark, sf):
    nested = a.nested_readings(
        Tables(spark, sf).events, "user_id", ["ts", "event_id", "value"], [F.date_format("ts", "yyyyMMdd").alias("ymd")]
    )
    text = F.array_join(F.transform("items", lambda r: r["value"].cast("string")), ",")
    return nested.select("user_id", "ymd", F.size("items").cast("long").alias("n"), text.alias("items"))


@query(
    "filtered_count_and_list",
    """WITH s AS (SELECT user_id, arg_max(event_id, ts) % 16 AS bits FROM events GROUP BY user_id),
       x AS (SELECT user_id, nm, substr(lpad(bin(bits), 4, '0'), pos, 1) = '1' AS hit FROM s CROSS JOIN (VALUES ('pump', 1), ('fan', 2), ('valve', 3), ('motor', 4)) m(nm, pos))
       SELECT nm AS alarm_name, count(*) FILTER (hit) AS hit_count, COALESCE(string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) FILTER (hit), '') AS devices FROM x GROUP BY nm""",
)
def filtered_count_and_list(spark, sf):
    from millstream.plans.joins import ALARMS

    latest = a.latest_per_key(Tables(spark, sf).events, "user_id", ["ts", "event_id"], ["event_id"])
    status = latest.select("user_id", F.lpad(F.bin(F.col("event_id") % 16), 4, "0").alias("digitals"))
    bits = joins.cross_join_alarm_map(status, "digitals", ALARMS)
    found = a.filtered_count_and_list(bits, "alarm_name", F.col("status_value") == 1, ["user_id"])
    text = F.array_join(F.transform("hits", lambda h: h["user_id"].cast("string")), ",")
    return found.select("alarm_name", "hit_count", text.alias("devices"))


@query(
    "wip_counts",
    """SELECT l_linestatus || l_returnflag AS op_cd, count(*) AS cnt, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) || '(' || CAST(sum(l_quantity) AS BIGINT) || ')' AS label
       FROM lineitem WHERE l_linestatus = 'O' AND CAST(l_shipdate AS DATE) >= DATE '1999-01-01' GROUP BY 1""",
)
def wip_counts(spark, sf):
    lines = Tables(spark, sf).lineitem.withColumn("op_cd", F.concat("l_linestatus", "l_returnflag"))
    recent = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    return a.wip_counts(lines, "op_cd", "l_quantity", (F.col("l_linestatus") == "O") & recent)


@query(
    "monthly_usage",
    """SELECT s_nationkey AS zone, l_suppkey, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, sum(l_quantity) AS usage_qty
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
)
def monthly_usage(spark, sf):
    t = Tables(spark, sf)
    zones = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as zone")
    return a.monthly_usage(t.lineitem.join(zones, "l_suppkey"), ["zone", "l_suppkey", "l_partkey"], "l_shipdate", "l_quantity")


@query("yearly_performance", "SELECT l_suppkey, strftime(l_shipdate, '%Y') AS year, sum(l_quantity) AS total_qty FROM lineitem GROUP BY 1, 2")
def yearly_performance(spark, sf):
    lines = Tables(spark, sf).lineitem.withColumn("ymd", F.date_format("l_shipdate", "yyyyMMdd"))
    return a.yearly_performance(lines, "l_suppkey", "ymd", "l_quantity")


@query(
    "annual_plan_vs_actual",
    """WITH b AS (SELECT o_custkey AS ws, o_orderstatus AS f, o_orderdate, o_totalprice, 1995 + CAST(o_custkey % 7 AS INTEGER) AS y FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1),
       p AS (SELECT y AS year, f, count(*) AS plan_cnt, CAST(round(sum(o_totalprice)) AS BIGINT) AS plan_total_qty FROM b WHERE year(o_orderdate) = y GROUP BY 1, 2),
       s0 AS (SELECT o_custkey AS ws, o_orderstatus AS f, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(l_shipdate AS DATE) DESC, o_orderstatus) = 1),
       s AS (SELECT year(d) AS year, f, count(*) AS prod_cnt, CAST(round(sum(q)) AS BIGINT) AS prod_total_qty FROM s0 GROUP BY 1, 2)
       SELECT CAST(COALESCE(p.year, s.year) AS INTEGER) AS year, COALESCE(p.f, s.f) AS factory, COALESCE(plan_cnt, 0) AS plan_cnt, COALESCE(plan_total_qty, 0) AS plan_total_qty,
              COALESCE(prod_cnt, 0) AS prod_cnt, COALESCE(prod_total_qty, 0) AS prod_total_qty FROM p FULL JOIN s ON p.year = s.year AND p.f = s.f""",
)
def annual_plan_vs_actual(spark, sf):
    t = Tables(spark, sf)
    bom = t.orders.select(F.col("o_custkey").alias("ws"), F.col("o_orderstatus").alias("factory"), "o_orderdate", "o_totalprice", "o_orderkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("date").alias("d"), "l_quantity", "l_returnflag")
    scan = lines.join(bom.select("o_orderkey", "ws", "factory"), "o_orderkey")
    year = (F.col("ws") % 7 + 1995).cast("int")
    return marts.annual_plan_vs_actual(
        bom, scan, "factory", "ws", year, "o_orderdate", "o_totalprice", [F.col("o_orderdate").desc(), F.col("o_orderkey")],
        F.col("l_returnflag") == "R", "d", "l_quantity",
    )


@query(
    "daily_plan_status",
    """WITH pl AS (SELECT o_orderpriority AS op, o_custkey AS ws, year(o_orderdate) AS seq, o_orderstatus AS chk, o_orderdate AS d, floor(o_totalprice / 1000) AS qty FROM orders),
       sc AS (SELECT o_orderpriority AS op, o_custkey AS ws, l_linenumber AS ps, l_shipdate AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       lp AS (SELECT op, ws FROM (SELECT * FROM pl QUALIFY rank() OVER (PARTITION BY op, ws ORDER BY seq DESC) = 1) WHERE chk = 'F' AND year(d) = 2000),
       m AS (SELECT op, ws, max(ps) AS ps FROM sc WHERE year(d) = 2000 GROUP BY 1, 2), ls AS (SELECT sc.op, sc.ws FROM sc JOIN m ON sc.op = m.op AND sc.ws = m.ws AND sc.ps = m.ps),
       t AS (SELECT op, ws FROM lp UNION SELECT op, ws FROM ls), q AS (SELECT DISTINCT t.op, t.ws, qty FROM t LEFT JOIN pl ON t.op = pl.op AND t.ws = pl.ws)
       SELECT op, count(*) AS plan_cnt, COALESCE(sum(qty), 0) AS plan_qty FROM q GROUP BY op""",
)
def daily_plan_status(spark, sf):
    t = Tables(spark, sf)
    plan = t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("op"), F.col("o_custkey").alias("ws"), F.year("o_orderdate").alias("seq"),
        F.col("o_orderstatus").alias("chk"), F.floor(F.col("o_totalprice") / 1000).cast("double").alias("qty"),
    )
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("ps"), F.year("l_shipdate").alias("y"))
    scan = lines.join(plan.select("o_orderkey", "op", "ws"), "o_orderkey")
    planned = (F.col("chk") == "F") & (F.col("seq") == 2000)
    return marts.daily_plan_status(plan, scan, ["op", "ws"], ["op"], "seq", planned, "ps", F.col("y") == 2000, "qty")


USAGE_SQL = """SELECT s_nationkey AS zone, l_partkey % 150 + 1 AS part_cd, CAST(o_orderdate AS DATE) AS wo_date, l_quantity - 5 AS qty, l_orderkey, l_linenumber
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""


def usage(spark, sf):
    t = Tables(spark, sf)
    zones = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as zone")
    days = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("wo_date"))
    lines = t.lineitem.join(zones, "l_suppkey").join(days, "l_orderkey")
    return lines.select(
        "zone", (F.col("l_partkey") % 150 + 1).alias("part_cd"), "wo_date", (F.col("l_quantity") - 5).alias("qty"),
        "l_orderkey", "l_linenumber", "l_suppkey",
    )


GAPS_SQL = f"""SELECT zone, part_cd, wo_date, lag(wo_date) OVER (PARTITION BY zone, part_cd ORDER BY wo_date) AS prev,
   date_diff('day', lag(wo_date) OVER (PARTITION BY zone, part_cd ORDER BY wo_date), wo_date) AS gap FROM ({USAGE_SQL})"""


@query(
    "lag_gap_days",
    f"SELECT zone, part_cd, strftime(wo_date, '%Y%m%d') AS wo_date, strftime(prev, '%Y%m%d') AS previous_day, CAST(gap AS INTEGER) AS gap_days FROM ({GAPS_SQL})",
)
def lag_gap_days(spark, sf):
    gaps = temporal.lag_gap_days(usage(spark, sf), ["zone", "part_cd"], "wo_date")
    text = {d: F.date_format(d, "yyyyMMdd") for d in ("wo_date", "previous_day")}
    return gaps.withColumns(text).select("zone", "part_cd", "wo_date", "previous_day", "gap_days")


@query(
    "replacement_cycle",
    f"SELECT zone, part_cd, CAST(round_even(avg(gap), 0) AS BIGINT) AS cycle_dt FROM ({GAPS_SQL}) GROUP BY 1, 2 HAVING count(gap) > 2",
)
def replacement_cycle(spark, sf):
    gaps = temporal.lag_gap_days(usage(spark, sf), ["zone", "part_cd"], "wo_date")
    return a.replacement_cycle(gaps, ["zone", "part_cd"], "gap_days")


@query("positive_min_max", f"SELECT zone, part_cd, min(qty) FILTER (qty > 0) AS min_qty, max(qty) AS max_qty FROM ({USAGE_SQL}) GROUP BY 1, 2")
def positive_min_max(spark, sf):
    return a.positive_min_max(usage(spark, sf), ["zone", "part_cd"], "qty")


@query(
    "spare_part_analysis",
    f"""WITH u AS ({USAGE_SQL}), g AS ({GAPS_SQL}),
        t AS (SELECT zone, part_cd, p_name, sum(qty) AS total_outgoing_qty, count(*) AS wo_cnt FROM u JOIN part ON part_cd = p_partkey GROUP BY zone, part_cd, p_name
              QUALIFY row_number() OVER (PARTITION BY zone ORDER BY sum(qty) DESC, part_cd, p_name) <= 10),
        c AS (SELECT zone, part_cd, CAST(round_even(avg(gap), 0) AS BIGINT) AS cycle_dt FROM g GROUP BY 1, 2 HAVING count(gap) > 2),
        q AS (SELECT s_nationkey AS zone, CAST(l_shipdate AS DATE) AS ymd, sum(l_quantity) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
        x AS (SELECT g.zone, g.part_cd, max(wo_date) AS cur, max(prev) AS prev FROM g GROUP BY 1, 2),
        w AS (SELECT g.zone, g.part_cd, sum(CASE WHEN ymd >= prev AND ymd <= wo_date THEN qty ELSE 0 END) AS total_qty, sum(CASE WHEN ymd > wo_date THEN qty ELSE 0 END) AS total_qty_recent
              FROM g SEMI JOIN t ON g.zone = t.zone AND g.part_cd = t.part_cd LEFT JOIN q ON g.zone = q.zone GROUP BY 1, 2),
        b AS (SELECT zone, part_cd, min(qty) FILTER (qty > 0) AS min_qty, max(qty) AS max_qty FROM u GROUP BY 1, 2)
        SELECT zone, part_cd, p_name, total_outgoing_qty, wo_cnt, rn, cycle_dt, strftime(cur, '%Y%m%d') AS current_wo_date, strftime(prev, '%Y%m%d') AS previous_wo_date, total_qty, total_qty_recent, min_qty, max_qty, stock_qty
        FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY total_outgoing_qty DESC, part_cd, p_name) AS rn FROM t) LEFT JOIN c USING (zone, part_cd) LEFT JOIN x USING (zone, part_cd)
        LEFT JOIN w USING (zone, part_cd) LEFT JOIN b USING (zone, part_cd) LEFT JOIN (SELECT p_partkey AS part_cd, p_size AS stock_qty FROM part) USING (part_cd)""",
)
def spare_part_analysis(spark, sf):
    t = Tables(spark, sf)
    used = usage(spark, sf).join(t.part.selectExpr("p_partkey as part_cd", "p_name"), "part_cd")
    zones = t.supplier.selectExpr("s_suppkey as l_suppkey", "s_nationkey as zone")
    made = t.lineitem.join(zones, "l_suppkey").select("zone", F.col("l_shipdate").cast("date").alias("ymd"), F.col("l_quantity").alias("made"))
    stock = t.part.selectExpr("p_partkey as part_cd", "p_size as stock", "p_brand as stock_date")
    result = marts.spare_part_analysis(
        used.select("zone", "part_cd", "p_name", "wo_date", "qty"), made, stock, ["zone", "part_cd"], ["zone"], "part_cd", "p_name",
        "wo_date", "qty", "ymd", "made", [F.col("stock_date").desc()], "stock",
    )
    text = {d: F.date_format(d, "yyyyMMdd") for d in ("current_wo_date", "previous_wo_date")}
    return result.withColumns(text).withColumn("rn", F.col("rn").cast("long"))


OEE_SQL = """WITH ev AS (SELECT event_id, user_id AS equip_id, event_type, ts, value, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events),
 sh AS (SELECT equip_id, d + to_hours(CAST(s * 8 AS INTEGER)) AS st, d + to_hours(CAST(s * 8 + 8 AS INTEGER)) AS en, s FROM (SELECT DISTINCT equip_id FROM ev), (SELECT DISTINCT date_trunc('day', ts) AS d FROM events), (SELECT unnest([0, 1, 2]) AS s)),
 run AS (SELECT sh.equip_id, st, sum(date_diff('microsecond', greatest(ts, st), least(nx, en)) / 1000000.0) AS run_sec FROM sh JOIN ev ON ev.equip_id = sh.equip_id AND event_type IN ('view', 'click') AND ts < en AND nx > st GROUP BY 1, 2),
 rep AS (SELECT sh.equip_id, st, sum(date_diff('microsecond', greatest(ts, st), least(nx, en)) / 1000000.0) AS repair_sec, count(*) AS repair_cnt FROM sh JOIN ev ON ev.equip_id = sh.equip_id AND event_type = 'error' AND ts < en AND nx > st GROUP BY 1, 2),
 prd AS (SELECT sh.equip_id, st, sum(value) AS total_cnt, sum(CASE WHEN event_id % 10 <> 0 THEN value ELSE 0 END) AS good_cnt FROM sh JOIN ev ON ev.equip_id = sh.equip_id AND event_type = 'purchase' AND ts BETWEEN st AND en GROUP BY 1, 2),
 alm AS (SELECT sh.equip_id, st, count(*) AS failure_cnt FROM sh JOIN ev ON ev.equip_id = sh.equip_id AND event_type = 'error' AND ts BETWEEN st AND en GROUP BY 1, 2),
 k AS (SELECT sh.equip_id, sh.s, sh.st, sh.en, COALESCE(run_sec, 0) AS run_sec, COALESCE(repair_sec, 0) AS repair_sec, COALESCE(repair_cnt, 0) AS repair_cnt, COALESCE(total_cnt, 0) AS total_cnt, COALESCE(good_cnt, 0) AS good_cnt, COALESCE(failure_cnt, 0) AS failure_cnt, (sh.equip_id % 5 + 1) * 20.0 AS cyc
       FROM sh LEFT JOIN run USING (equip_id, st) LEFT JOIN rep USING (equip_id, st) LEFT JOIN prd USING (equip_id, st) LEFT JOIN alm USING (equip_id, st)),
 r AS (SELECT *, run_sec / 28800.0 AS av, CASE WHEN run_sec <> 0 THEN total_cnt * cyc / run_sec ELSE 0 END AS pf, CASE WHEN total_cnt <> 0 THEN good_cnt / total_cnt ELSE 0 END AS ql FROM k)"""


@query(
    "oee_kpi",
    f"""{OEE_SQL} SELECT equip_id, CAST(s AS BIGINT) AS shift_id, st AS shift_start, round(av, 6) AS availability, round(pf, 6) AS performance, round(ql, 6) AS quality, round(av * pf * ql, 8) AS oee,
        round(CASE WHEN repair_cnt > 0 THEN repair_sec / 60.0 / repair_cnt ELSE 0 END, 3) AS mttr, round(CASE WHEN failure_cnt > 0 THEN run_sec / 3600.0 / failure_cnt ELSE 0 END, 3) AS mtbf FROM r""",
)
def oee_kpi(spark, sf):
    from millstream.operators import chunked

    events = Tables(spark, sf).events.withColumnRenamed("user_id", "equip_id")
    status = chunked.following(chunked.with_time_chunk(events, "ts"), "equip_id", ["ts", "event_id"], ["ts"], "nxt")
    status = status.select("equip_id", "event_id", "event_type", "value", F.col("ts").alias("start_time"), F.col("nxt.ts").alias("end_time"))
    code = F.when(F.col("event_type").isin("view", "click"), "RUN").otherwise("STOP")
    status = status.withColumn("status_code", code)
    equipment = events.select("equip_id").distinct()
    # The shift map: every machine works three shifts on every day of the data.
    first, last = (events.agg(f(F.col("ts").cast("date"))).scalar() for f in (F.min, F.max))
    # A machine makes many shifts, so the machines are dealt over a fixed number of tasks, which adaptive execution keeps;
    # by a hash of their own, as the plan would leave out a second shuffle by the same key.
    dealt = equipment.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("equip_id"))
    days = dealt.withColumns({"lo": first, "hi": last}).select("equip_id", F.explode(F.sequence("lo", "hi")).alias("d"))
    shift_map = days.withColumn("shift_id", F.explode(F.sequence(F.lit(0), F.lit(2))))
    begin = F.col("d").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("shift_id") * 8).cast("int"))
    shifts = shift_map.select("equip_id", F.col("shift_id").cast("long").alias("shift_id"), begin.alias("shift_start"))
    shifts = shifts.withColumn("shift_end", F.col("shift_start") + tk.interval("8 hours"))
    made = events.filter("event_type = 'purchase'").select(
        "equip_id", F.col("ts").alias("time"), F.col("value").alias("total_cnt"),
        F.when(F.col("event_id") % 10 != 0, F.col("value")).otherwise(0.0).alias("good_cnt"),
    )
    alarms = events.filter("event_type = 'error'").select("equip_id", F.col("ts").alias("time"))
    repairs = status.filter("event_type = 'error'").select("equip_id", "start_time", "end_time")
    config = equipment.select("equip_id", ((F.col("equip_id") % 5 + 1) * 20.0).alias("std_cycle_time"))
    kpi = marts.oee_kpi(shifts, status.select("equip_id", "status_code", "start_time", "end_time"), made, alarms, repairs, config)
    digits = {"availability": R, "performance": R, "quality": R, "oee": 8, "mttr": 3, "mtbf": 3}
    return kpi.select("equip_id", "shift_id", "shift_start", *[F.round(x, n).alias(x) for x, n in digits.items()])


@query(
    "mttr_mtbf_monthly",
    """WITH t AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'OS' WHEN 'O' THEN 'IP' WHEN 'P' THEN 'PH' END AS process, count(*) / 1000.0 AS tgt FROM orders GROUP BY 1),
       m AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'OS' WHEN 'O' THEN 'IP' WHEN 'P' THEN 'PH' END AS process, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS process_date, avg(o_totalprice / 1000) AS mttr, sum(o_totalprice) / 3600 / count(*) AS mtbf FROM orders GROUP BY 1, 2)
       SELECT process, process_date, round(mttr, 6) AS mttr, round(mtbf, 6) AS mtbf, CAST(tgt AS DOUBLE) AS mttr_target, CAST(tgt * 2 AS DOUBLE) AS mtbf_target FROM m JOIN t USING (process)""",
)
def mttr_mtbf_monthly(spark, sf):
    orders = Tables(spark, sf).orders
    line = c.labelled("o_orderstatus", {"F": "Outsole", "O": "IP", "P": "Phylon"})
    process = c.process_name_map(line, {"Outsole": "OS", "IP": "IP", "Phylon": "PH"})
    goal = F.count(F.lit(1)) / 1000.0
    targets = orders.groupBy(process.alias("process")).agg(goal.alias("mttr_target"), (goal * 2).alias("mtbf_target"))
    price = F.col("o_totalprice")
    mart = marts.mttr_mtbf_monthly(orders, process, "o_orderdate", price / 1000, price / 3600, targets)
    return mart.select(
        "process", F.date_format("process_date", "yyyy-MM-dd").alias("process_date"), F.round("mttr", R).alias("mttr"),
        F.round("mtbf", R).alias("mtbf"), "mttr_target", "mtbf_target",
    )


@query(
    "describe_stats",
    """SELECT count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75 FROM events""",
)
def describe_stats(spark, sf):
    stats = quantiles.describe_stats(Tables(spark, sf).events, "value")
    return stats.withColumns({x: F.round(x, R) for x in ("mean", "std", "p25", "p50", "p75")})


@query(
    "percentile_iqr",
    """WITH q AS (SELECT user_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY user_id)
       SELECT user_id, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence FROM q""",
)
def percentile_iqr(spark, sf):
    fences = quantiles.percentile_iqr(Tables(spark, sf).events, "user_id", "value")
    return fences.withColumns({x: F.round(x, R) for x in ("q1", "q3", "iqr", "lower_fence", "upper_fence")})


@query(
    "basic_stats",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(exp(avg(ln(l_quantity))), 6) AS geo_mean, round(quantile_cont(l_quantity, 0.5), 6) AS median, round(var_pop(l_quantity), 6) AS variance, round(stddev_pop(l_quantity), 6) AS stddev FROM lineitem GROUP BY 1, 2""",
)
def basic_stats(spark, sf):
    stats = quantiles.basic_stats(Tables(spark, sf).lineitem, ["l_returnflag", "l_linestatus"], "l_quantity")
    return stats.withColumns({x: F.round(x, R) for x in ("mean", "geo_mean", "median", "variance", "stddev")})


@query(
    "zero_fill_days",
    """WITH d AS (SELECT DISTINCT l_suppkey FROM lineitem), s AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
       SELECT strftime(x.day, '%Y%m%d') AS day, d.l_suppkey, COALESCE(q, 0) AS l_quantity FROM d CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS day) x LEFT JOIN s ON s.l_suppkey = d.l_suppkey AND s.day = x.day""",
)
def zero_fill_days(spark, sf):
    lines = Tables(spark, sf).lineitem.select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    filled = a.zero_fill_days(lines, "day", "l_suppkey", F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"), ["l_quantity"])
    return filled.withColumn("day", F.date_format("day", "yyyyMMdd"))


@query("first_event_per_id", "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def first_event_per_id(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "event_id", "ts", "event_type")
    return a.first_event_per_id(events, "user_id", ["ts", "event_id"])


@query("distinct_dedup", "SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1")
def distinct_dedup(spark, sf):
    orders = Tables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", "o_orderdate")
    return a.distinct_dedup(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "explode_detail",
    """WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), s AS (SELECT user_id, ts AS mt, value, event_type FROM events WHERE event_type IN ('view', 'click')),
       j AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 'L' ELSE 'U' END AS temp_type, mt, value FROM e JOIN s ON e.user_id = s.user_id AND mt BETWEEN ts - INTERVAL 7 HOUR AND ts)
       SELECT event_id, temp_type, CAST(row_number() OVER (PARTITION BY event_id, temp_type ORDER BY mt, value) AS INTEGER) AS seq_no, mt, value FROM j""",
)
def explode_detail(spark, sf):
    events = Tables(spark, sf).events
    bad = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    for kind in ("view", "click"):
        series = events.filter(F.col("event_type") == kind).select("user_id", F.col("ts").alias("mt"), "value")
        bad = temporal.lookback_interval_join(bad, series, "user_id", "event_id", "ts", "mt", "value", "7 hours")
        bad = bad.withColumnRenamed("readings", kind)
    return sequences.explode_detail(bad, "event_id", {"L": "view", "U": "click"})
