"""Scalar cleaning over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millstream.functions import cleaning as c
from millstream.functions import timekeys as tk
from millstream.operators import aggregates, alerts, joins
from millstream.plans.registry import Tables, query


@query("clean_string", "SELECT doc_id, md5(trim(replace(text, ',', ' '), ' ')) AS clean_md5 FROM documents")
def clean_string(spark, sf):
    return Tables(spark, sf).documents.select("doc_id", F.md5(c.clean_string("text")).alias("clean_md5"))


@query(
    "normalize_keys",
    """SELECT c_custkey, upper(trim('  ' || c_mktsegment || ' ')) AS segment,
              CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 2 THEN lpad(CAST(c_custkey AS VARCHAR), 2, '0')
                   ELSE CAST(c_custkey AS VARCHAR) END AS cust_key FROM customer""",
)
def normalize_keys(spark, sf):
    raw = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return Tables(spark, sf).customer.select(
        "c_custkey", c.normalize_key(raw, upper=True).alias("segment"), c.normalize_key("c_custkey", 2).alias("cust_key")
    )


MACHINE_SQL = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'PL' WHEN 1 THEN 'IP' WHEN 2 THEN 'CP' WHEN 3 THEN 'OS'
    ELSE 'XX' END AS wh, 'LN' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS ln,
    'MC' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS mc,
    'ST' || CASE WHEN p_size % 2 = 0 THEN '6' ELSE '3' END || CASE WHEN p_size % 3 = 0 THEN 'C' ELSE 'D' END
    || CAST(p_size % 10 AS VARCHAR) AS tb FROM part"""


@query(
    "machine_code_case",
    f"""SELECT p_partkey, CASE wh
          WHEN 'PL' THEN lpad(substr(mc, 3, 2), 3, '0') || '_MC' || lpad(substr(tb, 3, 1), 3, '0') || '_' ||
               CASE WHEN substr(tb, 1, 3) = 'ST6' THEN 'P_' ELSE substr(tb, 4, 1) || '_' END ||
               lpad(CASE WHEN substr(tb, 1, 3) = 'ST6' THEN CAST(CAST(substr(tb, 5, 1) AS INTEGER)
                    + CASE WHEN substr(tb, 4, 1) = 'C' THEN 0 ELSE 4 END AS VARCHAR) ELSE substr(tb, 5, 1) END, 3, '0')
          WHEN 'IP' THEN 'IPI-' || mc || '-' || substr(tb, 3, 2) || '-' || substr(tb, 5, 1)
          WHEN 'CP' THEN ln || '_' || mc || '_' || tb
          WHEN 'OS' THEN substr(ln, 3, 2) || '-' || mc END AS machine FROM ({MACHINE_SQL})""",
)
def machine_code_case(spark, sf):
    size, two = F.col("p_size"), F.lpad(F.col("p_size").cast("string"), 2, "0")
    workshop = F.element_at(F.array(*[F.lit(x) for x in ("PL", "IP", "CP", "OS", "XX")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    table = F.concat(
        F.lit("ST"), F.when(size % 2 == 0, "6").otherwise("3"), F.when(size % 3 == 0, "C").otherwise("D"),
        (size % 10).cast("string"),
    )
    code = c.machine_code_case(workshop, F.concat(F.lit("LN"), two), F.concat(F.lit("MC"), two), table)
    return Tables(spark, sf).part.select("p_partkey", code.alias("machine"))


@query(
    "split_station",
    """SELECT o_orderkey, CASE WHEN n >= 2 THEN p[n - 1] END AS station, CASE WHEN n >= 2 THEN p[n] END AS side FROM (
         SELECT o_orderkey, string_split(o_orderpriority, '-') AS p, len(string_split(o_orderpriority, '-')) AS n FROM orders)""",
)
def split_station(spark, sf):
    station, side = c.split_station("o_orderpriority")
    return Tables(spark, sf).orders.select("o_orderkey", station.alias("station"), side.alias("side"))


@query(
    "split_tag",
    """SELECT n_nationkey, concat_ws('_', split_part(t, '_', 1), split_part(t, '_', 2)) AS mc,
              regexp_extract(t, '^[^_]*_[^_]*_(.*)$', 1) AS prop
       FROM (SELECT n_nationkey, 'st_' || n_nationkey || '_Plate ' || n_name AS t FROM nation)""",
)
def split_tag(spark, sf):
    tag = F.concat(F.lit("st_"), "n_nationkey", F.lit("_Plate "), "n_name")
    mc, prop = c.split_tag(tag)
    return Tables(spark, sf).nation.select("n_nationkey", mc.alias("mc"), prop.alias("prop"))


@query("right_key", "SELECT c_custkey, right(c_name, 4) AS loc_id, substr(c_name, length(c_name) - 6, 2) AS pass_type FROM customer")
def right_key(spark, sf):
    return Tables(spark, sf).customer.select(
        "c_custkey", c.right_key("c_name", 4).alias("loc_id"), c.tail_substring("c_name", 6, 2).alias("pass_type")
    )


@query(
    "suffix_status_map",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'purchase' THEN 'T' WHEN 'view' THEN 'O'
              WHEN 'error' THEN 'S' END AS status FROM events""",
)
def suffix_status_map(spark, sf):
    names = {"signup": "A동 입고", "purchase": "A동 투입", "view": "B동 완료", "error": "라인 중단", "click": "라인 기타"}
    location = c.labelled("event_type", names)
    return Tables(spark, sf).events.select("event_id", c.suffix_status_map(location).alias("status"))


@query(
    "packed_xy",
    """SELECT event_id, split_part(xy, '/', 1) AS x, split_part(xy, '/', 2) AS y FROM (
         SELECT event_id, user_id || CASE WHEN event_type = 'error' THEN '' ELSE '/' || event_id END AS xy FROM events)""",
)
def packed_xy(spark, sf):
    tail = F.when(F.col("event_type") == "error", "").otherwise(F.concat(F.lit("/"), "event_id"))
    x, y = c.packed_xy(F.concat(F.col("user_id").cast("string"), tail))
    return Tables(spark, sf).events.select("event_id", x.alias("x"), y.alias("y"))


@query(
    "tag_decode",
    """SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'manual' WHEN 1 THEN 'Semi' WHEN 2 THEN 'Auto' END AS run_mode,
              CASE WHEN value * 20 > 1000 THEN NULL ELSE value * 20 END AS temp FROM events""",
)
def tag_decode(spark, sf):
    mode = c.tag_decode(F.col("user_id") % 4, c.PLC_STATE_LABELS["run_mode"])
    temp = c.null_above(F.col("value") * 20, 1000)
    return Tables(spark, sf).events.select("event_id", mode.alias("run_mode"), temp.alias("temp"))


@query(
    "lookup_or_self",
    """SELECT s_suppkey, COALESCE(n_name, s_code) AS n_name FROM (
         SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN CAST(s_nationkey AS VARCHAR) ELSE 'X' || s_nationkey END AS s_code
         FROM supplier) LEFT JOIN nation ON s_code = CAST(n_nationkey AS VARCHAR)
       WHERE COALESCE(n_name, s_code) NOT IN ('NATION_1', 'NATION_2', 'X21')""",
)
def lookup_or_self(spark, sf):
    t = Tables(spark, sf)
    key = F.col("s_nationkey").cast("string")
    code = F.when(F.col("s_nationkey") < 20, key).otherwise(F.concat(F.lit("X"), key))
    dim = t.nation.select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    allow = [f"NATION_{i}" for i in range(25) if i not in (1, 2)] + [f"X{i}" for i in range(20, 25) if i != 21]
    return joins.lookup_or_self(t.supplier.select("s_suppkey", code.alias("code")), dim, "code", "n_name", allow).drop("code")


@query(
    "season_name",
    """WITH d AS (SELECT lpad(CAST(n_nationkey + CASE WHEN n_nationkey < 15 THEN 0 ELSE 50 END AS VARCHAR), 2, '0') AS k, n_name FROM nation),
       x AS (SELECT o_orderkey, lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') || strftime(o_orderdate, '%y') AS code FROM orders)
       SELECT o_orderkey, COALESCE(n_name || substr(code, 3, 2), code) AS season FROM x LEFT JOIN d ON substr(code, 1, 2) = k""",
)
def season_name(spark, sf):
    t = Tables(spark, sf)
    dim = t.nation.select(F.lpad(F.expr("n_nationkey + if(n_nationkey < 15, 0, 50)").cast("string"), 2, "0").alias("k"), "n_name")
    code = F.concat(F.lpad((F.col("o_custkey") % 25).cast("string"), 2, "0"), F.date_format("o_orderdate", "yy"))
    rows = t.orders.select("o_orderkey", code.alias("code"))
    return joins.season_name(rows, dim, "code", "k", "n_name").drop("code")


@query("keyword_search", "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%WIDGET%' OR p_type ILIKE '%WIDGET%' OR p_brand ILIKE '%WIDGET%'")
def keyword_search(spark, sf):
    hit = c.keyword_search(["p_name", "p_type", "p_brand"], "WIDGET")
    return Tables(spark, sf).part.filter(hit).select("p_partkey", "p_name", "p_type")


@query(
    "optional_filters",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND upper(o_orderpriority) = upper('5-low')
       AND o_totalprice >= 1000 AND o_orderdate < TIMESTAMP '2000-01-01'""",
)
def optional_filters(spark, sf):
    params = {
        "o_orderstatus": ("eq", "F"),
        "o_orderpriority": ("ieq", "5-low"),
        "o_totalprice": ("ge", 1000.0),
        "o_custkey": ("eq", None),
        "o_orderdate": ("lt", dt.datetime(2000, 1, 1)),
    }
    return Tables(spark, sf).orders.filter(c.optional_filters(params)).select("o_orderkey", "o_totalprice")


KEY_SQL = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y%m')
  WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m')
  ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS k, o_orderdate AS d FROM orders"""


@query(
    "date_key_range",
    f"""SELECT o_orderkey, k AS date_key, CASE o_orderkey % 5 WHEN 0 THEN date_trunc('year', d) WHEN 1 THEN date_trunc('month', d)
          WHEN 3 THEN date_trunc('month', d) ELSE d END AS range_start,
          CASE o_orderkey % 5 WHEN 0 THEN date_trunc('year', d) + INTERVAL 1 YEAR WHEN 1 THEN date_trunc('month', d) + INTERVAL 1 MONTH
          WHEN 3 THEN date_trunc('month', d) + INTERVAL 1 MONTH WHEN 2 THEN d + INTERVAL 1 DAY ELSE d + INTERVAL 1 SECOND END AS range_end
        FROM ({KEY_SQL})""",
)
def date_key_range(spark, sf):
    kind = F.col("o_orderkey") % 5
    formats = ["yyyy", "yyyyMM", "yyyyMMdd", "yyyy-MM", "yyyy-MM-dd'T'HH:mm:ss"]
    key = F.coalesce(*[F.when(kind == i, F.date_format("o_orderdate", f)) for i, f in enumerate(formats)])
    start, end = tk.date_key_range("date_key")
    keyed = Tables(spark, sf).orders.select("o_orderkey", key.alias("date_key"))
    return keyed.select("o_orderkey", "date_key", start.alias("range_start"), end.alias("range_end"))


@query(
    "today_slice",
    """SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'""",
)
def today_slice(spark, sf):
    events = Tables(spark, sf).events
    today = tk.today_slice("ts", "2024-01-15 20:00:00", "UTC", "Asia/Jakarta")
    return events.filter(today).select("event_id", "ts")


@query(
    "last_3_months_filter",
    "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y%m') IN ('199806', '199805', '199804')",
)
def last_3_months_filter(spark, sf):
    recent = tk.last_3_months_filter(F.date_format("o_orderdate", "yyyyMM"), dt.date(1998, 6, 15))
    return Tables(spark, sf).orders.filter(recent).select("o_orderkey")


@query(
    "worksheet_status",
    """SELECT l_orderkey, l_linenumber, CASE WHEN s = 'Y' THEN 'I' WHEN s = 'C' THEN 'O' WHEN l_linestatus = 'O' AND s IS NULL THEN 'X'
              WHEN s IS NULL THEN 'N' END AS status, CASE WHEN s = 'C' THEN 'O' WHEN s = 'Y' THEN 'I' ELSE 'N' END AS summary
       FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'C' END AS s FROM lineitem)""",
)
def worksheet_status(spark, sf):
    status = c.labelled("l_returnflag", {"A": "Y", "R": "C"})
    checked = c.labelled("l_linestatus", {"O": "N", "F": "Y"})
    return Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", c.worksheet_status(status, checked).alias("status"),
        c.worksheet_status(status).alias("summary"),
    )


@query(
    "feedback_translate",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'o_F' WHEN o_orderstatus = 'O' THEN 'en_O' ELSE 'o_P' END AS category FROM orders""",
)
def feedback_translate(spark, sf):
    orders = Tables(spark, sf).orders
    status = F.col("o_orderstatus")
    dim = orders.select("o_orderstatus").distinct().select(
        "o_orderstatus", F.concat(F.lit("en_"), status).alias("en"),
        F.when(status != "O", F.concat(F.lit("o_"), status)).alias("vi"),
    )
    return joins.feedback_translate(orders.select("o_orderkey", "o_orderstatus"), dim, "o_orderstatus", "vi").drop("o_orderstatus")


@query(
    "plant_lookback_window",
    """WITH o AS (SELECT n_regionkey AS plant, max(n_nationkey) % 3 + 2 AS f, max(n_nationkey) % 2 AS t FROM nation GROUP BY n_regionkey)
       SELECT event_id, user_id % 5 AS plant FROM events JOIN o ON user_id % 5 = plant
       WHERE date_diff('microsecond', ts, TIMESTAMP '2024-01-15 12:00:00') / 3600000000.0 BETWEEN t AND f""",
)
def plant_lookback_window(spark, sf):
    t = Tables(spark, sf)
    offsets = t.nation.groupBy(F.col("n_regionkey").cast("long").alias("plant")).agg(
        (F.max("n_nationkey") % 3 + 2).alias("hours_from"), (F.max("n_nationkey") % 2).alias("hours_to")
    )
    events = t.events.select("event_id", (F.col("user_id") % 5).alias("plant"), "ts")
    return joins.plant_lookback_window(events, offsets, "plant", "ts", "2024-01-15 12:00:00").select("event_id", "plant")


@query("null_default", "SELECT event_id, COALESCE(CASE WHEN event_type <> 'error' THEN value END, 0) AS value FROM events")
def null_default(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return Tables(spark, sf).events.select("event_id", c.null_default(value, 0.0).alias("value"))


@query(
    "process_name_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'OS' WHEN 'O' THEN 'IP' WHEN 'P' THEN 'PH' END AS process,
              strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS process_date FROM orders""",
)
def process_name_map(spark, sf):
    line = c.labelled("o_orderstatus", {"F": "Outsole", "O": "IP", "P": "Phylon"})
    process = c.process_name_map(line, {"Outsole": "OS", "IP": "IP", "Phylon": "PH"})
    month = F.date_format(tk.month_start("o_orderdate"), "yyyyMMdd")
    return Tables(spark, sf).orders.select("o_orderkey", process.alias("process"), month.alias("process_date"))


@query(
    "range_to_line",
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 8 THEN 'LINE 1' WHEN p_size BETWEEN 9 AND 16 THEN 'LINE 2'
              WHEN p_size BETWEEN 17 AND 24 THEN 'LINE 3' WHEN p_size BETWEEN 25 AND 30 THEN 'LINE 4' ELSE 'UNKNOWN' END AS line_cd FROM part""",
)
def range_to_line(spark, sf):
    return Tables(spark, sf).part.select("p_partkey", c.range_to_line("p_size").alias("line_cd"))


@query(
    "round_pad_format",
    """SELECT event_id, round(value / 7, 3) AS pvalue, lpad(CAST(event_id AS VARCHAR), 11, '0') AS seqno,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') AS rxdate FROM events""",
)
def round_pad_format(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id", c.round_value(F.col("value") / 7, 3).alias("pvalue"), c.zero_pad("event_id", 11).alias("seqno"),
        c.iso_time("ts").alias("rxdate"),
    )


@query(
    "bitstring_alarm",
    """SELECT event_id, CASE WHEN substr(d, 3, 1) = '' THEN '0' ELSE substr(d, 3, 1) END AS running FROM (
         SELECT event_id, ltrim(CAST(bin(event_id % 16) AS VARCHAR), '0') || CASE WHEN event_id % 16 = 0 THEN '0' ELSE '' END AS d FROM events)""",
)
def bitstring_alarm(spark, sf):
    digitals = F.bin(F.col("event_id") % 16)
    return Tables(spark, sf).events.select("event_id", c.bitstring_alarm(digitals, 3).alias("running"))


@query(
    "threshold_status",
    """WITH th AS (SELECT event_type, unnest([1, 2, 3]) AS level_no, q1, q2, q3 FROM (
           SELECT event_type, round(quantile_cont(value, 0.5), 2) AS q1, round(quantile_cont(value, 0.9), 2) AS q2,
                  round(quantile_cont(value, 0.99), 2) AS q3 FROM events GROUP BY event_type)),
       lv AS (SELECT event_type, level_no, CASE level_no WHEN 1 THEN q1 WHEN 2 THEN q2 ELSE q3 END AS lo,
                     CASE level_no WHEN 1 THEN q3 END AS hi FROM th)
       SELECT event_id, arg_max(level_no, level_no) AS threshold_id,
              CASE max(level_no) WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' WHEN 1 THEN 'warning' ELSE 'normal' END AS status,
              COALESCE(max(level_no) >= 1, false) AS is_alert
       FROM events e LEFT JOIN lv ON e.event_type = lv.event_type AND (lo IS NULL OR value >= lo) AND (hi IS NULL OR value <= hi)
       GROUP BY event_id""",
)
def threshold_status(spark, sf):
    from millstream.operators.quantiles import exact_quantiles

    events = Tables(spark, sf).events
    quantiles = exact_quantiles(events, ["event_type"], "value", [0.5, 0.9, 0.99], ["q1", "q2", "q3"])
    levels = F.array(
        *[
            F.struct(
                F.lit(i).alias("threshold_id"), F.lit(level).alias("level"), F.round(f"q{i}", 2).alias("min_value"),
                (F.round("q3", 2) if i == 1 else F.lit(None).cast("double")).alias("max_value"),
            )
            for i, level in ((1, "medium"), (2, "yellow"), (3, "red"))
        ]
    )
    thresholds = quantiles.select("event_type", F.explode(levels).alias("t")).select("event_type", "t.*")
    rows = alerts.threshold_status(
        events.select("event_id", "event_type", "value"), thresholds, "event_type", "value", "threshold_id"
    )
    return rows.select("event_id", "threshold_id", "status", "is_alert")


@query(
    "diff_level",
    """WITH ctrl AS (SELECT CASE WHEN s_acctbal > 5000 THEN s_suppkey ELSE -s_suppkey END AS s_suppkey, s_nationkey + 5.0 AS a, s_nationkey + 10.0 AS b, s_nationkey + 30.0 AS ct FROM supplier),
       x AS (SELECT l_orderkey, l_linenumber, l_quantity AS diff, COALESCE(a, 10.0) AS a, COALESCE(b, 20.0) AS b, COALESCE(ct, 40.0) AS ct
             FROM lineitem LEFT JOIN ctrl ON l_suppkey = s_suppkey)
       SELECT l_orderkey, l_linenumber, CASE WHEN diff < a THEN 'A' WHEN diff < b THEN 'B' WHEN diff < ct THEN 'C' ELSE 'D' END AS diff_level,
              CASE WHEN diff < b THEN 'Info' WHEN diff < ct THEN CASE WHEN diff <= b + (ct - b) * 0.6 THEN 'Info' ELSE 'Warning' END ELSE 'Urgent' END AS event_level,
              CAST(CASE WHEN diff < a THEN 0 WHEN diff < b THEN a WHEN diff < ct THEN b ELSE ct END AS DOUBLE) AS set_value FROM x""",
)
def diff_level(spark, sf):
    t = Tables(spark, sf)
    nation = F.col("s_nationkey").cast("double")
    ctrl = t.supplier.select(
        F.expr("if(s_acctbal > 5000, s_suppkey, -s_suppkey)").alias("l_suppkey"), (nation + 5).alias("level_a_to"), (nation + 10).alias("level_b_to"),
        (nation + 30).alias("level_c_to"),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("diff"))
    judged = rows.join(ctrl, "l_suppkey", "left").withColumns(c.diff_level("diff"))
    return judged.select("l_orderkey", "l_linenumber", "diff_level", "event_level", "set_value")


@query(
    "warning_temp_check",
    """SELECT l_orderkey, l_linenumber, CASE WHEN lim IS NULL OR l_quantity >= lim THEN 'AboveWarning' ELSE 'NoIssue' END AS event_type,
              CASE WHEN l_quantity >= lim THEN 'Warning' ELSE 'Info' END AS event_level, lim AS set_value
       FROM lineitem LEFT JOIN (SELECT CASE WHEN s_acctbal > 2000 THEN s_suppkey ELSE -s_suppkey END AS s_suppkey, CAST(s_nationkey + 20 AS DOUBLE) AS lim FROM supplier) ON l_suppkey = s_suppkey""",
)
def warning_temp_check(spark, sf):
    t = Tables(spark, sf)
    limits = t.supplier.selectExpr("if(s_acctbal > 2000, s_suppkey, -s_suppkey) as l_suppkey", "double(s_nationkey + 20) as t_warning")
    rows = t.lineitem.join(limits, "l_suppkey", "left").withColumns(c.warning_temp_check("l_quantity", "t_warning"))
    return rows.select("l_orderkey", "l_linenumber", "event_type", "event_level", "set_value")


@query(
    "surrogate_key",
    """SELECT event_id, md5(concat_ws('-', CAST(user_id AS VARCHAR), event_type, COALESCE(CASE WHEN event_type <> 'error' THEN props END,
              '_dbt_utils_surrogate_key_null_'))) AS row_key FROM events""",
)
def surrogate_key(spark, sf):
    props = F.when(F.col("event_type") != "error", F.col("props"))
    return Tables(spark, sf).events.select("event_id", c.surrogate_key("user_id", "event_type", props).alias("row_key"))


@query("safe_add", "SELECT event_id, COALESCE(CASE WHEN event_type <> 'view' THEN value END, 0) + event_id + 0 AS total FROM events")
def safe_add(spark, sf):
    value = F.when(F.col("event_type") != "view", F.col("value"))
    return Tables(spark, sf).events.select("event_id", c.safe_add(value, "event_id", F.lit(None).cast("int")).alias("total"))


@query("safe_subtract", "SELECT event_id, COALESCE(CASE WHEN event_type <> 'view' THEN value END, 0) - event_id AS total FROM events")
def safe_subtract(spark, sf):
    value = F.when(F.col("event_type") != "view", F.col("value"))
    return Tables(spark, sf).events.select("event_id", c.safe_subtract(value, "event_id").alias("total"))


@query(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN round(l_quantity / l_discount, 6) END AS ratio FROM lineitem",
)
def safe_divide(spark, sf):
    ratio = F.round(c.safe_divide("l_quantity", "l_discount"), 6)
    return Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


@query(
    "width_bucket",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 400000 THEN 7
              ELSE CAST(floor((o_totalprice - 100000) / 50000) AS BIGINT) + 1 END AS bucket FROM orders""",
)
def width_bucket(spark, sf):
    return Tables(spark, sf).orders.select(
        "o_orderkey", c.width_bucket("o_totalprice", 100000.0, 400000.0, 6).alias("bucket")
    )


@query(
    "haversine",
    """SELECT c_custkey, round(2 * 3961 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2))
              * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))) * 1.60934, 4) AS km FROM (
         SELECT c_custkey, c_nationkey * 3.0 AS lat1, CAST(c_custkey % 180 AS DOUBLE) AS lon1, c_nationkey + 1.5 AS lat2, c_custkey % 90 + 0.25 AS lon2 FROM customer)""",
)
def haversine(spark, sf):
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    km = c.haversine(nation * 3.0, (key % 180).cast("double"), nation + 1.5, key % 90 + 0.25, "km")
    return Tables(spark, sf).customer.select("c_custkey", F.round(km, 4).alias("km"))


_URL = "^(?:[a-z][a-z0-9+.-]*://)?"


@query("url_host", f"SELECT page_id, regexp_extract(url, '{_URL}([^/?#]+)', 1) AS host FROM pages")
def url_host(spark, sf):
    return Tables(spark, sf).pages.select("page_id", c.url_host("url").alias("host"))


@query("url_path", f"SELECT page_id, regexp_extract(url, '{_URL}[^/?#]+/([^?#]*)', 1) AS path FROM pages")
def url_path(spark, sf):
    return Tables(spark, sf).pages.select("page_id", c.url_path("url").alias("path"))


@query("url_parameter", "SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_no FROM pages")
def url_parameter(spark, sf):
    return Tables(spark, sf).pages.select("page_id", c.url_parameter("url", "page").alias("page_no"))


@query(
    "slugify",
    """SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_size || '-' || p_name || '#' || p_brand), '[ -]+', '_', 'g'),
              '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug FROM part""",
)
def slugify(spark, sf):
    text = F.concat_ws("", F.col("p_size").cast("string"), F.lit("-"), "p_name", F.lit("#"), "p_brand")
    return Tables(spark, sf).part.select("p_partkey", c.slugify(text).alias("slug"))


@query("star_except", "SELECT c_custkey AS src_c_custkey, c_name AS src_c_name, c_nationkey AS src_c_nationkey FROM customer")
def star_except(spark, sf):
    return aggregates.star_except(Tables(spark, sf).customer, ["c_acctbal", "c_mktsegment"], prefix="src_")


@query("get_column_values", "SELECT p_brand, count(*) AS cnt FROM part GROUP BY p_brand")
def get_column_values(spark, sf):
    return aggregates.get_column_values(Tables(spark, sf).part, "p_brand")


@query("get_single_value", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)")
def get_single_value(spark, sf):
    orders = Tables(spark, sf).orders
    top = aggregates.get_single_value(orders, F.max("o_totalprice"))
    return orders.filter(F.col("o_totalprice") == top).select("o_orderkey", "o_totalprice")
