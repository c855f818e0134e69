"""Set operations and ordering over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.operators import sets
from millstream.plans.registry import Tables, query
from millstream.session import stored


@query("union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def union_distinct(spark, sf):
    t = Tables(spark, sf)
    return sets.union_distinct(t.orders.selectExpr("o_custkey as k"), t.customer.selectExpr("c_custkey as k"))


@query(
    "union_all_relabel",
    """SELECT o_orderkey AS id, o_orderdate AS at, o_orderpriority AS reason_cd, o_totalprice AS qty FROM orders
       UNION ALL SELECT l_orderkey, l_shipdate, 'good', CAST(NULL AS DOUBLE) FROM lineitem""",
)
def union_all_relabel(spark, sf):
    t = Tables(spark, sf)
    bad = t.orders.selectExpr("o_orderkey as id", "o_orderdate as at", "o_orderpriority as reason_cd", "o_totalprice as qty")
    return sets.union_all_relabel(bad, t.lineitem, {"id": "l_orderkey", "at": "l_shipdate"}, {"reason_cd": "good"})


@query("concat_drop_duplicates", "SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events UNION SELECT s_suppkey FROM supplier")
def concat_drop_duplicates(spark, sf):
    t = Tables(spark, sf)
    frames = [t.orders.selectExpr("o_custkey as k"), t.events.selectExpr("user_id as k"), t.supplier.selectExpr("s_suppkey as k")]
    return sets.concat_drop_duplicates(frames)


@query(
    "union_relations",
    """SELECT 'customer' AS source_relation, c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS size FROM customer
       UNION ALL SELECT 'part', p_partkey, p_name, NULL, CAST(p_size AS BIGINT) FROM part""",
)
def union_relations(spark, sf):
    t = Tables(spark, sf)
    frames = {
        "customer": t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment", "c_acctbal as balance"),
        "part": t.part.selectExpr("p_partkey as id", "p_name as name", "bigint(p_size) as size"),
    }
    return sets.union_relations(frames, exclude=["balance"])


@query(
    "except_equality",
    """WITH a AS (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'), b AS (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'),
       d AS (SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
       SELECT which_diff, l_suppkey, l_quantity, count(*) AS times FROM d GROUP BY ALL""",
)
def except_equality(spark, sf):
    lines = Tables(spark, sf).lineitem.select("l_suppkey", "l_quantity", "l_returnflag")
    a, b = (lines.filter(f).drop("l_returnflag") for f in ("l_returnflag <> 'R'", "l_returnflag = 'R'"))
    return sets.except_equality(a, b)


@query("order_limit_offset", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id LIMIT 100 OFFSET 50")
def order_limit_offset(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "ts", "value")
    return sets.order_limit_offset(events, [F.col("ts").desc(), F.col("event_id")], 100, 50)


@query(
    "natural_sort",
    """SELECT c_custkey, sensor, row_number() OVER (ORDER BY seg, k, c_custkey) AS pos FROM (SELECT c_custkey, lower(c_mktsegment) AS seg, c_custkey % 200 AS k, c_mktsegment || '_' || (c_custkey % 200) AS sensor FROM customer)""",
)
def natural_sort(spark, sf):
    from millstream.operators import chunked

    sensors = Tables(spark, sf).customer.select("c_custkey", F.concat_ws("_", "c_mktsegment", F.col("c_custkey") % 200).alias("sensor"))
    # The position makes the order visible in an unordered comparison: rows are numbered in each range of the sort, and
    # ranges are offset by the rows before them. The sorted rows are kept, so that ranges are the same in both passes.
    ranges = stored(sets.natural_sort(sensors, "sensor", "c_custkey").withColumn(chunked.CHUNK, F.spark_partition_id()), "natural-sort")
    return chunked.numbered(ranges.withColumn("nk", sets.natural_key("sensor")), [], ["nk", "sensor", "c_custkey"], "pos").select("c_custkey", "sensor", "pos")


@query("pending_queue", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 100")
def pending_queue(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    return sets.pending_queue(orders, "o_orderstatus", "P", [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderstatus")
