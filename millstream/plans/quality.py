"""Data tests over the driver's tables: the failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.operators import quality as dq
from millstream.plans.registry import Tables, query


def gappy(spark, sf):
    """Orders with some missing and repeated values."""
    return Tables(spark, sf).orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("status"), "o_totalprice", "o_orderdate",
    )


GAPPY = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS priority, CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END AS status, o_totalprice, o_orderdate FROM orders"""


@query("dq_not_null", f"SELECT o_orderkey FROM ({GAPPY}) WHERE priority IS NULL")
def dq_not_null(spark, sf):
    return dq.dq_not_null(gappy(spark, sf), "priority").select("o_orderkey")


@query("dq_unique", "SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def dq_unique(spark, sf):
    return dq.dq_unique(Tables(spark, sf).orders, "o_custkey")


@query("dq_accepted_values", "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1")
def dq_accepted_values(spark, sf):
    return dq.dq_accepted_values(Tables(spark, sf).events, "event_type", ["view", "click", "purchase"])


@query("dq_not_accepted_values", "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type IN ('error', 'fatal') GROUP BY 1")
def dq_not_accepted_values(spark, sf):
    return dq.dq_not_accepted_values(Tables(spark, sf).events, "event_type", ["error", "fatal"])


@query("dq_accepted_range", "SELECT event_id, value FROM events WHERE value < 1 OR value > 150")
def dq_accepted_range(spark, sf):
    return dq.dq_accepted_range(Tables(spark, sf).events, "value", 1, 150).select("event_id", "value")


@query(
    "dq_equal_rowcount",
    """SELECT k, CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b FROM (SELECT l_suppkey AS k, 1 AS a, 0 AS b FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT l_suppkey, 0, 1 FROM lineitem WHERE l_returnflag = 'R') GROUP BY k HAVING sum(a) <> sum(b)""",
)
def dq_equal_rowcount(spark, sf):
    lines = Tables(spark, sf).lineitem.select(F.col("l_suppkey").alias("k"), "l_returnflag")
    return dq.dq_equal_rowcount(lines.filter("l_returnflag <> 'R'"), lines.filter("l_returnflag = 'R'"), ["k"])


@query(
    "dq_fewer_rows_than",
    """SELECT k, CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b FROM (SELECT l_suppkey AS k, 1 AS a, 0 AS b FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT l_suppkey, 0, 1 FROM lineitem WHERE l_returnflag = 'R') GROUP BY k HAVING sum(a) >= sum(b)""",
)
def dq_fewer_rows_than(spark, sf):
    lines = Tables(spark, sf).lineitem.select(F.col("l_suppkey").alias("k"), "l_returnflag")
    return dq.dq_fewer_rows_than(lines.filter("l_returnflag <> 'R'"), lines.filter("l_returnflag = 'R'"), ["k"])


@query(
    "dq_cardinality_equality",
    """SELECT v AS value_field, CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b FROM (SELECT o_custkey AS v, 1 AS a, 0 AS b FROM orders UNION ALL SELECT user_id, 0, 1 FROM events) GROUP BY v HAVING sum(a) <> sum(b)""",
)
def dq_cardinality_equality(spark, sf):
    t = Tables(spark, sf)
    return dq.dq_cardinality_equality(t.orders, "o_custkey", t.events, "user_id")


@query("dq_expression_is_true", f"SELECT o_orderkey FROM ({GAPPY}) WHERE NOT COALESCE(priority < '4' AND o_totalprice > 100, false)")
def dq_expression_is_true(spark, sf):
    expression = (F.col("priority") < "4") & (F.col("o_totalprice") > 100)
    return dq.dq_expression_is_true(gappy(spark, sf), expression).select("o_orderkey")


@query("dq_recency", "SELECT user_id, max(ts) AS most_recent FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 00:00:00'")
def dq_recency(spark, sf):
    return dq.dq_recency(Tables(spark, sf).events, "ts", "1 day", "2024-01-31", ["user_id"])


@query(
    "dq_at_least_one",
    "SELECT user_id, count(CASE WHEN event_type = 'error' AND value > 50 THEN value END) AS filled FROM events GROUP BY user_id HAVING filled = 0",
)
def dq_at_least_one(spark, sf):
    rare = F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.col("value"))
    return dq.dq_at_least_one(Tables(spark, sf).events.withColumn("rare", rare), "rare", ["user_id"])


@query("dq_not_constant", "SELECT o_custkey, min(o_orderstatus) AS low, max(o_orderstatus) AS high FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1")
def dq_not_constant(spark, sf):
    return dq.dq_not_constant(Tables(spark, sf).orders, "o_orderstatus", ["o_custkey"])


@query("dq_not_empty_string", f"SELECT o_orderkey FROM ({GAPPY}) WHERE trim(status) = ''")
def dq_not_empty_string(spark, sf):
    return dq.dq_not_empty_string(gappy(spark, sf), "status").select("o_orderkey")


@query("dq_not_null_proportion", f"SELECT o_custkey, round(count(priority) / count(*), 6) AS not_null_proportion FROM ({GAPPY}) GROUP BY o_custkey HAVING count(priority) / count(*) < 0.8")
def dq_not_null_proportion(spark, sf):
    found = dq.dq_not_null_proportion(gappy(spark, sf), "priority", 0.8, group_by=["o_custkey"])
    return found.withColumn("not_null_proportion", F.round("not_null_proportion", 6))


@query(
    "dq_relationships_where",
    "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def dq_relationships_where(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    found = dq.dq_relationships_where(orders, "o_custkey", t.customer, "c_custkey", F.col("o_orderstatus") == "F", F.col("c_acctbal") > 0)
    return found.drop("o_orderstatus")


RANGES = """SELECT o_custkey, o_orderdate AS vf, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + to_days(CAST(o_orderkey % 200 AS INTEGER)) END AS vt FROM orders"""
RANGE_NEXT = f"SELECT *, lead(vf) OVER (PARTITION BY o_custkey ORDER BY vf, vt NULLS FIRST) AS next_lower FROM ({RANGES})"


def ranges(spark, sf):
    days = F.make_dt_interval((F.col("o_orderkey") % 200).cast("int"))
    upper = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + days)
    return Tables(spark, sf).orders.select("o_custkey", F.col("o_orderdate").alias("vf"), upper.alias("vt"))


def range_sql(meets: str) -> str:
    return f"""SELECT * FROM ({RANGE_NEXT}) WHERE NOT (COALESCE(vf < vt, next_lower IS NULL AND vt IS NULL) AND (next_lower IS NULL OR COALESCE({meets}, false)))"""


@query("dq_mutually_exclusive_ranges", range_sql("vt <= next_lower"))
def dq_mutually_exclusive_ranges(spark, sf):
    return dq.dq_mutually_exclusive_ranges(ranges(spark, sf), "vf", "vt", ["o_custkey"])


@query("dq_ranges_gap_required", range_sql("vt < next_lower"))
def dq_ranges_gap_required(spark, sf):
    return dq.dq_mutually_exclusive_ranges(ranges(spark, sf), "vf", "vt", ["o_custkey"], gaps="required")


@query("dq_ranges_no_gap", range_sql("vt = next_lower"))
def dq_ranges_no_gap(spark, sf):
    return dq.dq_mutually_exclusive_ranges(ranges(spark, sf), "vf", "vt", ["o_custkey"], gaps="not_allowed")


@query(
    "dq_sequential_values",
    "SELECT * FROM (SELECT event_type, event_id, lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS previous_value FROM events) WHERE previous_value IS NOT NULL AND event_id <> previous_value + 1",
)
def dq_sequential_values(spark, sf):
    return dq.dq_sequential_values(Tables(spark, sf).events, "event_id", 1, ["event_type"])


@query(
    "dq_sequential_days",
    """SELECT * FROM (SELECT l_suppkey, d, lag(d) OVER (PARTITION BY l_suppkey ORDER BY d) AS previous_value FROM (SELECT DISTINCT l_suppkey, l_shipdate AS d FROM lineitem)) WHERE previous_value IS NOT NULL AND d <> previous_value + INTERVAL 1 DAY""",
)
def dq_sequential_days(spark, sf):
    days = Tables(spark, sf).lineitem.select("l_suppkey", F.col("l_shipdate").alias("d")).distinct()
    return dq.dq_sequential_values(days, "d", "1 day", ["l_suppkey"])


@query("dq_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, sf):
    return dq.dq_unique_combination(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_group_by", "SELECT c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 500) AS BIGINT) AS band, min(c_custkey) AS low, max(c_custkey) AS high FROM customer GROUP BY 1, 2, 3 HAVING count(DISTINCT c_custkey) = 1")
def dq_group_by(spark, sf):
    customers = Tables(spark, sf).customer.withColumn("band", F.floor(F.col("c_acctbal") / 500))
    return dq.dq_not_constant(customers, "c_custkey", ["c_nationkey", "c_mktsegment", "band"])


@query(
    "date_spine",
    """SELECT o_orderpriority, strftime(unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)), '%Y%m%d') AS date_day FROM (SELECT o_orderpriority, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)""",
)
def date_spine(spark, sf):
    bounds = Tables(spark, sf).orders.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return dq.date_spine(bounds, "lo", "hi").withColumn("date_day", F.date_format("date_day", "yyyyMMdd"))


@query("generate_series", "SELECT p_partkey, unnest(range(1, p_size + 1)) AS generated_number FROM part")
def generate_series(spark, sf):
    bounds = Tables(spark, sf).part.selectExpr("p_partkey", "bigint(p_size) as p_size")
    return dq.generate_series(bounds, "p_size").withColumn("generated_number", F.col("generated_number").cast("long"))
