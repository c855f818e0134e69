"""Metric anomalies over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.functions import timekeys as tk
from millstream.operators import observability as ob
from millstream.operators import sets
from millstream.plans.registry import Tables, query

COLS = ["bucket", "metric", "value", "training_avg", "training_stddev", "min_value", "max_value", "is_anomalous"]


def shown(points, extra=(), digits=6):
    rounded = ("value", "training_avg", "training_stddev", "min_value", "max_value")
    return points.select(*extra, *[F.round(c, digits).alias(c) if c in rounded else F.col(c) for c in COLS])


def scored_sql(
    points: str, part: str = "metric", extra: str = "", k: float = 3.0, n: int = 14, odd: str = "value > hi OR value < lo",
    hi: str = "a + {k} * s", lo: str = "a - {k} * s", min_n: int = 7, zero: bool = False, digits: int = 6,
) -> str:
    """SQL twin of the scorer over rows (bucket, metric, value)."""
    hi, lo = hi.format(k=k), lo.format(k=k)
    test = f"(({odd}) AND n >= {min_n})" + (" OR value = 0" if zero else "")
    return f"""WITH pt AS ({points}), w AS (SELECT *, avg(value) OVER z AS a, COALESCE(stddev_samp(value) OVER z, 0) AS s, count(value) OVER z AS n FROM pt
          WINDOW z AS (PARTITION BY {part} ORDER BY bucket ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)), l AS (SELECT *, {hi} AS hi, {lo} AS lo FROM w)
        SELECT {extra} bucket, metric, round(value, {digits}) AS value, round(a, {digits}) AS training_avg, round(s, {digits}) AS training_stddev, round(lo, {digits}) AS min_value, round(hi, {digits}) AS max_value,
          COALESCE({test}, false) AS is_anomalous FROM l"""


DAYS = "SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM {t}), (SELECT date_trunc('day', max(ts)) FROM {t}), INTERVAL 1 DAY)) AS bucket"
VOLUME = f"""SELECT d.bucket, 'row_count' AS metric, CAST(count(ts) AS DOUBLE) AS value FROM ({DAYS.format(t='events')}) d LEFT JOIN events ON date_trunc('day', ts) = d.bucket GROUP BY 1"""


@query("do_volume_anomalies", scored_sql(VOLUME, k=2.0))
def do_volume_anomalies(spark, sf):
    return shown(ob.do_volume_anomalies(Tables(spark, sf).events, "ts", "1 day", sensitivity=2.0))


HOURLY = """SELECT h.bucket, 'row_count' AS metric, CAST(count(ts) AS DOUBLE) AS value FROM (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events WHERE event_type = 'error'),
  (SELECT date_trunc('hour', max(ts)) FROM events WHERE event_type = 'error'), INTERVAL 1 HOUR)) AS bucket) h LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON date_trunc('hour', ts) = h.bucket GROUP BY 1"""


@query(
    "do_volume_directional",
    scored_sql(HOURLY, k=1.5, n=48, hi="greatest(a + {k} * s, a * (1 + 30 / 100.0))", odd="value > hi", zero=True),
)
def do_volume_directional(spark, sf):
    return shown(
        ob.do_volume_anomalies(
            Tables(spark, sf).events, "ts", "1 hour", F.col("event_type") == "error", sensitivity=1.5, days_back=48,
            direction="spike", ignore_spike_pct=30, fail_on_zero=True,
        )
    )


@query("do_volume_seasonal", scored_sql(VOLUME, part="metric, isodow(bucket)", k=1.5, min_n=2))
def do_volume_seasonal(spark, sf):
    return shown(
        ob.do_volume_anomalies(Tables(spark, sf).events, "ts", "1 day", seasonality="day_of_week", sensitivity=1.5, min_training=2)
    )


FRESH = """SELECT d.bucket, 'freshness' AS metric, greatest(g, date_diff('microsecond', max(l) OVER (ORDER BY d.bucket), d.bucket + INTERVAL 1 DAY) / 1000000.0) AS value
  FROM (%s) d LEFT JOIN (SELECT date_trunc('day', ts) AS bucket, max(date_diff('microsecond', p, ts) / 1000000.0) AS g, max(ts) AS l
    FROM (SELECT ts, lag(ts) OVER (ORDER BY ts) AS p FROM (SELECT DISTINCT ts FROM events)) GROUP BY 1) x ON x.bucket = d.bucket""" % DAYS.format(t="events")


@query("do_freshness_anomalies", scored_sql(FRESH, k=2.0, odd="value > hi", digits=3))
def do_freshness_anomalies(spark, sf):
    return shown(ob.do_freshness_anomalies(Tables(spark, sf).events, "ts", "1 day", sensitivity=2.0), digits=3)


LOADED = "(SELECT *, ts + to_minutes(CAST(user_id % 90 AS INTEGER)) AS load_ts FROM events)"


@query(
    "do_event_freshness",
    scored_sql(
        f"""SELECT d.bucket, 'event_freshness' AS metric, COALESCE(max(date_diff('microsecond', ts, load_ts) / 1000000.0), 0) AS value FROM ({DAYS.format(t=LOADED).replace('min(ts)', 'min(load_ts)').replace('max(ts)', 'max(load_ts)')}) d
            LEFT JOIN {LOADED} e ON date_trunc('day', load_ts) = d.bucket GROUP BY 1""",
        odd="value > hi",
    ),
)
def do_event_freshness(spark, sf):
    late = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("user_id") % 90).cast("int"))
    events = Tables(spark, sf).events.withColumn("load_ts", F.col("ts") + late)
    return shown(ob.do_event_freshness(events, "ts", "load_ts", "1 day"))


def sparse(spark, sf):
    value = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    kind = F.when(F.col("event_id") % 4 != 0, F.col("event_type")).otherwise("null")
    return Tables(spark, sf).events.select("ts", "user_id", "event_type", value.alias("value"), kind.alias("kind"))


SPARSE = "(SELECT ts, user_id, event_type, CASE WHEN event_id % 9 <> 0 THEN value END AS value, CASE WHEN event_id % 4 <> 0 THEN event_type ELSE 'null' END AS kind FROM events)"
NUMERIC = {
    "null_count": "count(*) FILTER (value IS NULL)", "null_percent": "count(*) FILTER (value IS NULL) * 100.0 / count(*)", "missing_count": "count(*) FILTER (value IS NULL)",
    "sum": "sum(value)", "average": "avg(value)", "standard_deviation": "stddev_samp(value)", "variance": "var_samp(value)", "min": "min(value)", "max": "max(value)",
    "zero_count": "count(*) FILTER (value = 0)",
}


@query(
    "do_column_anomalies",
    scored_sql(" UNION ALL ".join(f"SELECT date_trunc('day', ts) AS bucket, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM {SPARSE} GROUP BY 1" for m, e in NUMERIC.items()), digits=7),
)
def do_column_anomalies(spark, sf):
    return shown(ob.do_column_anomalies(sparse(spark, sf), "ts", "value", "1 day", list(NUMERIC)), digits=7)


TEXT = {
    "kind__missing_count": "count(*) FILTER (kind = 'null')", "kind__min_length": "min(length(kind))", "kind__max_length": "max(length(kind))", "kind__average_length": "avg(length(kind))",
    "kind__null_count": "count(*) FILTER (kind IS NULL)", "value__null_count": "count(*) FILTER (value IS NULL)", "value__missing_count": "count(*) FILTER (value IS NULL)",
}


@query(
    "do_all_columns",
    scored_sql(" UNION ALL ".join(f"SELECT date_trunc('day', ts) AS bucket, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM {SPARSE} GROUP BY 1" for m, e in TEXT.items())),
)
def do_all_columns(spark, sf):
    monitors = ["missing_count", "min_length", "max_length", "average_length", "null_count"]
    return shown(ob.do_all_columns(sparse(spark, sf), "ts", ["kind", "value"], "1 day", monitors))


DIMENSION = f"""SELECT v.event_type, d.bucket, 'dimension' AS metric, CAST(count(ts) AS DOUBLE) AS value FROM ({DAYS.format(t='events')}) d CROSS JOIN (SELECT DISTINCT event_type FROM events) v
  LEFT JOIN events e ON date_trunc('day', ts) = d.bucket AND e.event_type = v.event_type GROUP BY 1, 2"""


@query("do_dimension_anomalies", scored_sql(DIMENSION, part="event_type", extra="event_type,", k=1.5, odd="value < lo"))
def do_dimension_anomalies(spark, sf):
    found = ob.do_dimension_anomalies(Tables(spark, sf).events, "ts", ["event_type"], "1 day", sensitivity=1.5, direction="drop")
    return shown(found, ["event_type"])


UNTIL = "SELECT unnest(generate_series((SELECT date_trunc('{u}', min(ts)) FROM events{w}), TIMESTAMP '{last}', INTERVAL 1 {u})) AS bucket"
STOPPED = UNTIL.format(u="DAY", last="2024-02-09", w="")


@query("do_volume_stopped", scored_sql(VOLUME.replace(DAYS.format(t="events"), STOPPED), k=2.0, odd="value < lo"))
def do_volume_stopped(spark, sf):
    """The feed ends with January and is judged on 10 February."""
    found = ob.do_volume_anomalies(Tables(spark, sf).events, "ts", "1 day", as_of="2024-02-10 06:00:00", sensitivity=2.0, direction="drop")
    return shown(found)


@query("do_freshness_stopped", scored_sql(FRESH.replace(DAYS.format(t="events"), STOPPED), k=2.0, odd="value > hi", digits=3))
def do_freshness_stopped(spark, sf):
    found = ob.do_freshness_anomalies(Tables(spark, sf).events, "ts", "1 day", "2024-02-10 20:00:00", detection_delay="12 hours", sensitivity=2.0)
    return shown(found, digits=3)


@query("do_dimension_stopped", scored_sql(DIMENSION.replace(DAYS.format(t="events"), STOPPED), part="event_type", extra="event_type,", k=1.5, odd="value < lo"))
def do_dimension_stopped(spark, sf):
    found = ob.do_dimension_anomalies(Tables(spark, sf).events, "ts", ["event_type"], "1 day", as_of="2024-02-10", sensitivity=1.5, direction="drop")
    return shown(found, ["event_type"])


@query(
    "do_column_where",
    scored_sql(f"""SELECT b.bucket, 'null_count' AS metric, CAST(count(*) FILTER (ts IS NOT NULL AND value IS NULL) AS DOUBLE) AS value FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events WHERE event_type <> 'view'), (SELECT date_trunc('day', max(ts)) FROM events WHERE event_type <> 'view'), INTERVAL 1 DAY)) AS bucket) b
        JOIN (SELECT * FROM {SPARSE} WHERE event_type <> 'view') e ON date_trunc('day', ts) = b.bucket GROUP BY 1"""),
)
def do_column_where(spark, sf):
    return shown(ob.do_column_anomalies(sparse(spark, sf), "ts", "value", "1 day", ["null_count"], where=F.col("event_type") != "view"))


MONTHS = """SELECT b.bucket, 'row_count' AS metric, CAST(count(o_orderkey) AS DOUBLE) AS value FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders)::TIMESTAMP,
  (SELECT date_trunc('month', max(o_orderdate)) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS bucket) b LEFT JOIN orders ON date_trunc('month', o_orderdate) = b.bucket GROUP BY 1"""


@query("do_volume_monthly", scored_sql(MONTHS, k=1.0))
def do_volume_monthly(spark, sf):
    orders = Tables(spark, sf).orders.withColumn("at", F.col("o_orderdate").cast("timestamp_ntz"))
    return shown(ob.do_volume_anomalies(orders, "at", "1 month", sensitivity=1.0))


@query(
    "do_volume_of_runs",
    scored_sql(f"""SELECT * FROM ({VOLUME}) UNION ALL SELECT TIMESTAMP '2024-03-01', 'row_count', CAST(count(*) AS DOUBLE) FROM customer""", k=2.0),
)
def do_volume_of_runs(spark, sf):
    """A table without time column, after runs that counted as many rows as there were events a day."""
    return shown(ob.do_volume_of_runs(Tables(spark, sf).customer, volume_points(spark, sf), "2024-03-01", sensitivity=2.0))


def volume_points(spark, sf):
    return ob.bucket_metrics(Tables(spark, sf).events, "ts", "1 day", {"row_count": F.count(F.lit(1))}, fill={"row_count": 0})


@query("do_exclude_metrics", scored_sql(f"SELECT * FROM ({VOLUME}) WHERE NOT (isodow(bucket) = 7 OR value > 360)", k=1.0))
def do_exclude_metrics(spark, sf):
    exclude = (F.weekday("bucket") == 6) | (F.col("value") > 360)
    return shown(ob.do_exclude_metrics(volume_points(spark, sf), exclude, sensitivity=1.0))


@query("do_anomaly_range", f"SELECT bucket, is_anomalous, COALESCE(value >= min_value AND value <= max_value, true) AS in_range FROM ({scored_sql(VOLUME, k=1.0, min_n=1)})")
def do_anomaly_range(spark, sf):
    found = ob.do_anomaly_range(volume_points(spark, sf), sensitivity=1.0, min_training=1)
    return found.select("bucket", "is_anomalous", "in_range")


@query(
    "do_metric_backfill",
    f"""SELECT bucket, metric, CASE WHEN bucket >= (SELECT date_trunc('day', max(ts)) - INTERVAL 4 DAY FROM events) THEN value ELSE value + 0.5 END AS value FROM ({VOLUME})""",
)
def do_metric_backfill(spark, sf):
    events = Tables(spark, sf).events
    # The stored history ends two days before the newest bucket and differs from the truth by a half.
    fresh = volume_points(spark, sf)
    day = {n: F.date_trunc("day", f("ts")).cast("timestamp_ntz").alias(n) for n, f in (("first", F.min), ("last", F.max))}
    span = events.agg(*day.values())
    stale = fresh.crossJoin(F.broadcast(span)).filter(F.col("bucket") <= F.col("last") - tk.interval("2 days"))  # one row
    history = stale.select("bucket", "metric", (F.col("value") + 0.5).alias("value"))
    begin = ob.backfill_from(history, "row_count", span, 5)
    recent = fresh.crossJoin(F.broadcast(begin)).filter("bucket >= recompute_from").drop("recompute_from")  # one row
    return ob.do_metric_backfill(history, recent)


@query(
    "do_schema_changes",
    """WITH body AS (SELECT ts < TIMESTAMP '2024-01-15' AS early, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN json_object('k', event_id, 'old', event_type) ELSE json_object('k', CAST(event_id AS VARCHAR), 'zone', user_id) END AS j FROM events),
       f AS (SELECT early, unnest(json_keys(j)) AS c, j FROM body),
       t AS (SELECT early, c AS column_name, CASE WHEN json_type(j, '$.' || c) IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE 'STRING' END AS kind, count(*) AS n FROM f GROUP BY ALL),
       m AS (SELECT early, column_name, arg_max(kind, (n, kind)) AS kind FROM t GROUP BY 1, 2)
       SELECT COALESCE(a.column_name, b.column_name) AS column_name, a.kind AS pre_data_type, b.kind AS data_type,
              CASE WHEN a.kind IS NULL THEN 'column_added' WHEN b.kind IS NULL THEN 'column_removed' ELSE 'type_changed' END AS change
       FROM (SELECT * FROM m WHERE early) a FULL JOIN (SELECT * FROM m WHERE NOT early) b ON a.column_name = b.column_name
       WHERE a.kind IS DISTINCT FROM b.kind""",
)
def do_schema_changes(spark, sf):
    events = Tables(spark, sf).events
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    before = F.to_json(F.struct(F.col("event_id").alias("k"), F.col("event_type").alias("old")))
    after = F.to_json(F.struct(F.col("event_id").cast("string").alias("k"), F.col("user_id").alias("zone")))
    old = ob.observed_schema(events.filter(early).select(before.alias("body")), "body")
    new = ob.observed_schema(events.filter(~early).select(after.alias("body")), "body")
    return ob.do_schema_changes(old, new)


@query("do_missing_count", f"SELECT event_type, count(*) FILTER (kind = 'null') AS kind_missing, count(*) FILTER (value IS NULL) AS value_missing FROM {SPARSE} GROUP BY 1")
def do_missing_count(spark, sf):
    return ob.do_missing_count(sparse(spark, sf), ["kind", "value"], ["event_type"])


@query(
    "do_jsonschema",
    """SELECT event_id FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '{"name": "ab"}' WHEN 2 THEN '{"k": "text", "name": "abc"}' WHEN 3 THEN 'broken' WHEN 4 THEN '{"k": 5, "name": "abcdefghijkl"}' ELSE '{"k": 7, "name": "abc"}' END AS j, event_id % 6 AS m FROM events) WHERE m IN (1, 2, 3, 4)""",
)
def do_jsonschema(spark, sf):
    kind = F.col("event_id") % 6
    texts = ['{"name": "ab"}', '{"k": "text", "name": "abc"}', "broken", '{"k": 5, "name": "abcdefghijkl"}', '{"k": 7, "name": "abc"}']
    body = F.when(kind == 0, F.col("props"))
    for i, text in enumerate(texts, 1):
        body = body.when(kind == i, text)
    schema = {"k": {"type": "integer", "required": True}, "name": {"type": "string", "minLength": 2, "maxLength": 10}}
    rows = Tables(spark, sf).events.select("event_id", body.alias("body"))
    return ob.do_jsonschema(rows, "body", schema).select("event_id")


@query("do_failed_row_count", "SELECT 'count' AS calc, CAST(count(*) AS BIGINT) AS failed_row_count FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'sum', CAST(sum(n) AS BIGINT) FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1)")
def do_failed_row_count(spark, sf):
    from millstream.operators.quality import dq_unique

    failures = dq_unique(Tables(spark, sf).orders, "o_custkey")
    counted = {"count": ob.do_failed_row_count(failures), "sum": ob.do_failed_row_count(failures, F.sum("n_records"))}
    return sets.union_relations(counted, source_column="calc")
