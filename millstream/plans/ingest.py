"""Sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.functions.timekeys import interval
from millstream.operators import sets
from millstream.operators.quality import load_count_validation
from millstream.plans.registry import Tables, query
from millstream.session import shared_path
from millstream.sources import progress, readers, snapshots, writers

UPDATED = "ts + make_dt_interval(0, cast(user_id % 5 as int), 0, 0)"
UPDATED_SQL = "ts + to_hours(CAST(user_id % 5 AS INTEGER))"


@query(
    "jdbc_range_extract",
    """SELECT event_id, ts, user_id, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""",
)
def jdbc_range_extract(spark, sf):
    cols = ["event_id", "ts", "user_id", "value"]
    return readers.range_extract(Tables(spark, sf).events, cols, "ts", "2024-01-05", "2024-01-12")


@query(
    "or_range_extract",
    f"""SELECT event_id, ts, {UPDATED_SQL} AS upd_ts FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11'
           OR {UPDATED_SQL} BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11'""",
)
def or_range_extract(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "ts", F.expr(UPDATED).alias("upd_ts"))
    return readers.or_range_extract(events, ["ts", "upd_ts"], "2024-01-10", "2024-01-11")


@query(
    "coalesced_event_time",
    """SELECT event_id, COALESCE(CASE WHEN event_type <> 'error' THEN ts END,
                                 CASE WHEN user_id % 2 = 0 THEN ts + INTERVAL 1 MINUTE END,
                                 ts + INTERVAL 2 MINUTE) AS event_time FROM events""",
)
def coalesced_event_time(spark, sf):
    times = [
        F.when(F.col("event_type") != "error", F.col("ts")),
        F.when(F.col("user_id") % 2 == 0, F.col("ts") + interval("1 minute")),
        F.col("ts") + interval("2 minutes"),
    ]
    return readers.coalesced_event_time(Tables(spark, sf).events, times, "event_time").select("event_id", "event_time")


@query(
    "enriched_extract",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, COALESCE(s.s_name, 'UNKNOWN') AS s_name
       FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = CASE WHEN s_acctbal > 0 THEN s.s_suppkey ELSE -s.s_suppkey END""",
)
def enriched_extract(spark, sf):
    t = Tables(spark, sf)
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    # Some suppliers have another key in the dimension, so that facts miss them.
    dim = t.supplier.selectExpr("if(s_acctbal > 0, s_suppkey, -s_suppkey) as l_suppkey", "s_name")
    return readers.enriched_extract(facts, dim, "l_suppkey", {"s_name": "UNKNOWN"})


@query(
    "multi_source_union",
    """SELECT 'P1' AS company_cd, c_custkey AS site_key, c_name AS site_name, c_nationkey AS nation FROM customer
       UNION ALL SELECT 'P2', s_suppkey, s_name, s_nationkey FROM supplier""",
)
def multi_source_union(spark, sf):
    t = Tables(spark, sf)
    first = t.customer.selectExpr("c_custkey as site_key", "c_name as site_name", "c_nationkey as nation")
    second = t.supplier.selectExpr("s_suppkey as site_key", "s_name as site_name", "s_nationkey as nation")
    return sets.multi_source_union({"P1": first, "P2": second}, "company_cd")


HEAD = ["ymd", "hmsf", "sensor_id", "device_id", "capture_dt"]


@query(
    "csv_scan",
    """SELECT CASE WHEN event_type IN ('click', 'view') THEN 'CUR' ELSE 'VIB' END || CAST(user_id AS VARCHAR) AS sensor_id,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS capture_dt,
              CASE WHEN event_type IN ('click', 'view') THEN value END AS r,
              CASE WHEN event_type NOT IN ('click', 'view') THEN value END AS x,
              CASE WHEN event_type NOT IN ('click', 'view') THEN CAST(event_id AS DOUBLE) END AS freq FROM events""",
)
def csv_scan(spark, sf):
    events = Tables(spark, sf).events
    current = F.col("event_type").isin("click", "view")
    sensor = F.concat(F.when(current, "CUR").otherwise("VIB"), F.col("user_id").cast("string"))
    head = [
        F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmmss"), sensor, F.lit("dev"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    ]
    value, freq = F.col("value").cast("string"), F.col("event_id").cast("string")
    line = F.concat_ws(",", *head, value, value, value, F.when(~current, freq))
    path = shared_path(spark, "csv-scan")
    events.select(line.alias("value")).write.text(path)
    routes = {"CUR": [*HEAD, "r", "s", "t"], "VIB": [*HEAD, "x", "y", "z", "freq"]}
    frames = readers.csv_scan(spark, path, routes)
    both = frames["CUR"].unionByName(frames["VIB"], allowMissingColumns=True)
    return both.select("sensor_id", "capture_dt", "r", "x", "freq")


@query(
    "filter_numeric_key",
    """SELECT k AS row_key, o_totalprice FROM (
         SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'X' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS k,
                o_totalprice FROM orders) WHERE regexp_full_match(k, '[0-9]+')""",
)
def filter_numeric_key(spark, sf):
    key = F.concat(F.when(F.col("o_orderpriority").startswith("1"), "X").otherwise(""), F.col("o_orderkey"))
    orders = Tables(spark, sf).orders.select(key.alias("row_key"), "o_totalprice")
    return readers.filter_numeric_key(orders, "row_key")


@query(
    "csv_sink_partitioned",
    """SELECT lang, doc_id, md5(translate(regexp_replace(text, '[\\t\\r\\n]', ' ', 'g'), ',"', '  ')) AS text_md5
       FROM documents""",
)
def csv_sink_partitioned(spark, sf):
    docs = Tables(spark, sf).documents.select("doc_id", "text", "lang")
    path = shared_path(spark, "csv-sink")
    writers.csv_sink_partitioned(docs, path, ["lang"])
    back = (
        spark.read.schema("doc_id long, text string, lang string")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxCharsPerColumn", -1)
        .csv(path)
    )
    return back.select("lang", "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query(
    "csv_load_by_filename",
    """SELECT o_orderkey, o_totalprice, 'F' || (o_custkey % 2) AS factory, 'line' || o_orderstatus AS connection, '10.0.0.' || (o_custkey % 3) AS ip, 'order' AS category,
              't' || left(o_orderpriority, 1) AS "table", CAST(year(o_orderdate) AS VARCHAR) || '0101' AS start, CAST(year(o_orderdate) AS VARCHAR) || '1231' AS "end" FROM orders""",
)
def csv_load_by_filename(spark, sf):
    """Files whose folder has the name that a raw file has."""
    path = shared_path(spark, "csv-names")
    k, year = F.col("o_custkey"), F.year("o_orderdate")
    name = F.concat_ws(
        "_", F.concat(F.lit("F"), k % 2), F.concat(F.lit("line"), "o_orderstatus"), F.concat(F.lit("10.0.0."), k % 3), F.lit("order"),
        F.concat(F.lit("t"), F.left("o_orderpriority", F.lit(1))), F.concat(year, F.lit("0101")), F.concat(year, F.lit("1231")),
    )
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", name.alias("name"))
    writers.by_partition(orders, ["name"]).write.option("header", True).partitionBy("name").csv(path)
    schema = T.StructType().add("o_orderkey", "long").add("o_totalprice", "double")
    loaded = readers.csv_load_by_filename(spark, path, schema, level=-2)
    return loaded.select("o_orderkey", "o_totalprice", *readers.FILE_FIELDS)


@query(
    "file_date_filter",
    """SELECT * FROM (SELECT '/raw/machine_' || user_id || '_' || strftime(ts, '%Y%m%d') || '_hmi.csv' AS path,
                CAST(count(*) * 100 AS BIGINT) AS length FROM events GROUP BY user_id, strftime(ts, '%Y%m%d'))
       WHERE regexp_extract(path, '_(\\d{8})_', 1) BETWEEN '20240105' AND '20240120' AND length >= 200""",
)
def file_date_filter(spark, sf):
    name = F.concat(
        F.lit("/raw/machine_"), F.col("user_id"), F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit("_hmi.csv")
    )
    files = Tables(spark, sf).events.groupBy(name.alias("path")).agg((F.count(F.lit(1)) * 100).alias("length"))
    kept = readers.file_date_filter(files, dt.date(2024, 1, 5), dt.date(2024, 1, 20), min_size=200)
    return kept.select("path", "length")


@query(
    "nested_json_flatten",
    """WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd FROM orders),
       l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem)
       SELECT 'frame' AS kind, CAST(o_orderkey AS VARCHAR) AS device, ymd, '000000' AS hms, CAST(NULL AS INTEGER) AS area_id,
              max(l_quantity) AS max, min(l_quantity) AS min FROM d JOIN l ON l_orderkey = o_orderkey
       GROUP BY o_orderkey, ymd
       UNION ALL SELECT 'roi', CAST(o_orderkey AS VARCHAR), ymd, '000000', l_linenumber, l_extendedprice, l_quantity
       FROM d JOIN l ON l_orderkey = o_orderkey
       UNION ALL SELECT 'box', CAST(o_orderkey AS VARCHAR), ymd, '000000', l_linenumber, l_extendedprice, l_quantity
       FROM d JOIN l ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
)
def nested_json_flatten(spark, sf):
    t = Tables(spark, sf)
    area = F.struct(
        F.col("l_linenumber").alias("id"), F.lit("area").alias("name"),
        F.struct(F.col("l_extendedprice").alias("max"), F.col("l_quantity").alias("min")).alias("temp"),
    )
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(area).alias("roi"),
        F.collect_list(F.when(F.col("l_returnflag") == "R", area)).alias("box"),
        F.struct(F.max("l_quantity").alias("max"), F.min("l_quantity").alias("min")).alias("temp"),
    )
    doc = F.to_json(
        F.struct(
            F.lit("P1").alias("plant"),
            F.col("o_orderkey").cast("string").alias("device"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.struct("temp").alias("frame"),
            "roi",
            "box",
        )
    )
    docs = t.orders.join(lines, "o_orderkey").select(doc.alias("body"))
    frame, roi, box = readers.nested_json_flatten(docs, "body")
    cols = ["device", "ymd", "hms", "area_id", "max", "min"]
    frame = frame.withColumn("area_id", F.lit(None).cast("int"))
    parts = {"frame": frame, "roi": roi, "box": box}
    return sets.union_relations(parts, include=cols, source_column="kind").select("kind", *cols)


def ymd():
    return F.date_format("ts", "yyyyMMdd").alias("ymd")


@query(
    "upsert",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS ymd, CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value
       FROM events""",
)
def upsert(spark, sf):
    events = Tables(spark, sf).events
    path = shared_path(spark, "upsert")
    order = [F.col("value").desc()]
    writers.upsert(spark, path, events.select("event_id", ymd(), "value"), ["event_id", "ymd"], order, ["ymd"])
    late = events.filter("event_type = 'error'").select("event_id", ymd(), (F.col("value") * 2).alias("value"))
    writers.upsert(spark, path, late, ["event_id", "ymd"], order, ["ymd"])
    return snapshots.read(spark, path).select("event_id", "ymd", "value")


@query(
    "upsert_do_nothing",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value FROM events",
)
def upsert_do_nothing(spark, sf):
    events = Tables(spark, sf).events
    path = shared_path(spark, "upsert-nothing")
    order = [F.col("value")]
    known = events.filter("event_type <> 'error'").select("event_id", "value")
    writers.upsert_do_nothing(spark, path, known, ["event_id"], order)
    again = events.select("event_id", (F.col("value") + 1).alias("value"))
    writers.upsert_do_nothing(spark, path, again, ["event_id"], order)
    return spark.read.parquet(path)


@query(
    "bulk_append",
    "SELECT doc_id, lang, md5(regexp_replace(text, '[\\t\\r\\n]', ' ', 'g')) AS text_md5 FROM documents",
)
def bulk_append(spark, sf):
    docs = Tables(spark, sf).documents.select("doc_id", "lang", "text")
    path = shared_path(spark, "append")
    writers.bulk_append(docs.filter("lang = 'en'"), path)
    writers.bulk_append(docs.filter("lang <> 'en' or lang is null"), path)
    return spark.read.parquet(path).select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query("replace_table", "SELECT p_partkey, p_brand, p_size + 1 AS p_size FROM part")
def replace_table(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_brand", "p_size")
    path = shared_path(spark, "replace")
    writers.replace_table(part, path)
    writers.replace_table(part.withColumn("p_size", F.col("p_size") + 1), path)
    return spark.read.parquet(path)


@query(
    "replace_slice",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END
              AS o_totalprice FROM orders""",
)
def replace_slice(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = shared_path(spark, "slice")
    writers.replace_slice(orders, path, ["o_orderstatus"])
    fresh = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.replace_slice(fresh, path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "multi_sink",
    """SELECT target, 'success' AS status, n, total FROM (SELECT count(*) AS n, round(sum(l_quantity), 2) AS total
       FROM lineitem) CROSS JOIN (VALUES ('mysql'), ('postgres')) t(target)""",
)
def multi_sink(spark, sf):
    lines = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    paths = {name: shared_path(spark, f"sink-{name}") for name in ("mysql", "postgres")}
    status = writers.multi_sink(lines, {n: (lambda df, p=p: writers.replace_table(df, p)) for n, p in paths.items()})
    counts = [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total")).select(
            F.lit(n).alias("target"), F.lit(status[n]).alias("status"), "n", "total"
        )
        for n, p in paths.items()
    ]
    return counts[0].union(counts[1])


@query(
    "conform_to_schema",
    """SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS DOUBLE) AS credit,
              CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
)
def conform_to_schema(spark, sf):
    target = (
        T.StructType().add("c_name", "string").add("c_custkey", "string").add("credit", "double")
        .add("c_nationkey", "long").add("c_acctbal", "double")
    )
    return readers.conform_to_schema(Tables(spark, sf).customer, target, drop=["c_acctbal"])


@query(
    "append_audit_cols",
    """SELECT o_orderkey, TIMESTAMP '2024-02-01 00:00:00' AS etl_extract_time, TIMESTAMP '2024-02-01 00:05:00'
              AS etl_ingest_time FROM orders""",
)
def append_audit_cols(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey")
    return readers.append_audit_cols(orders, "2024-02-01 00:00:00", "2024-02-01 00:05:00")


@query(
    "incremental_range",
    """WITH p AS (SELECT event_type AS job, max(ts) - INTERVAL 3 DAY AS marker FROM events GROUP BY event_type)
       SELECT job, date_trunc('day', marker) + INTERVAL 390 MINUTE AS range_start,
              least(date_trunc('day', marker + INTERVAL 1 DAY) + INTERVAL 390 MINUTE,
                    TIMESTAMP '2024-01-31 06:30:00') AS range_end FROM p
       WHERE date_trunc('day', marker) + INTERVAL 390 MINUTE < least(date_trunc('day', marker + INTERVAL 1 DAY)
             + INTERVAL 390 MINUTE, TIMESTAMP '2024-01-31 06:30:00')""",
)
def incremental_range(spark, sf):
    marker = (F.max("ts") - interval("3 days")).alias("marker")
    state = Tables(spark, sf).events.groupBy(F.col("event_type").alias("job")).agg(marker)
    return progress.incremental_range(state, "job", "marker", "2024-01-31 12:00:00", "1 day", align="06:30")


BOUNDS_SQL = """SELECT event_type, date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi
                FROM events GROUP BY event_type"""


def event_bounds(spark, sf, unit="hour"):
    lo, hi = (F.date_trunc(unit, f("ts")).cast("timestamp_ntz") for f in (F.min, F.max))
    return Tables(spark, sf).events.groupBy("event_type").agg(lo.alias("lo"), hi.alias("hi"))


@query(
    "backfill_windows",
    f"""SELECT event_type, s AS chunk_start, least(s + INTERVAL 6 HOUR - INTERVAL 1 SECOND, hi) AS chunk_end
        FROM (SELECT event_type, hi, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS s FROM ({BOUNDS_SQL}))""",
)
def backfill_windows(spark, sf):
    return progress.backfill_windows(event_bounds(spark, sf), "lo", "hi", "6 hours")


@query(
    "delta_history_advance",
    f"""SELECT event_type, lo AS last_start, hi AS next_start,
               least(hi + INTERVAL 1 DAY, TIMESTAMP '2024-01-31 05:50:00') AS next_end
        FROM ({BOUNDS_SQL}) WHERE hi < least(hi + INTERVAL 1 DAY, TIMESTAMP '2024-01-31 05:50:00')""",
)
def delta_history_advance(spark, sf):
    bounds = event_bounds(spark, sf)
    return progress.delta_history_advance(
        bounds, "event_type", "lo", "hi", "1 day", "2024-01-31 06:00:00", "10 minutes"
    )


@query("full_refresh_dim", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def full_refresh_dim(spark, sf):
    path = shared_path(spark, "dim")
    writers.full_refresh_dim(Tables(spark, sf).part, path)
    return spark.read.parquet(path).select("p_partkey", "p_name", "p_brand", "p_type")


@query(
    "load_count_validation",
    """SELECT count(*) AS row_count, count(DISTINCT user_id) AS id_count FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
)
def load_validation(spark, sf):
    day = F.col("ts")
    inside = (day >= F.lit("2024-01-10").cast("timestamp_ntz")) & (day < F.lit("2024-01-20").cast("timestamp_ntz"))
    return load_count_validation(Tables(spark, sf).events, "user_id", inside)


@query(
    "min_marker",
    """SELECT least(min(m), TIMESTAMP '2024-01-29 00:00:00') AS next_run FROM (
         SELECT event_type, max(ts) AS m FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY event_type)""",
)
def min_marker(spark, sf):
    state = Tables(spark, sf).events.groupBy("event_type").agg(F.max("ts").alias("marker"))
    return progress.min_marker(state, "event_type", "marker", ["click", "view", "error"], "2024-01-30 00:00:00")
