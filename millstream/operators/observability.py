"""Metric history and anomaly detection over time buckets.

Facts are reduced to one metric row per bucket (and dimension value) with map-side aggregation. All statistics
then run on those small metric rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.functions.timekeys import as_ntz, interval
from millstream.functions.wallclock import bucket_begin, bucket_no, us_to_ntz, wall_us, width_us
from millstream.operators import chunked
from millstream.operators.chunked import join_null_safe, names

DEFAULT_DAYS_BACK = 14
DEFAULT_SENSITIVITY = 3.0


def last_bucket(bucket: str, as_of, detection_delay: str | None = None) -> Column:
    """Number of the last bucket that is complete at `as_of`, less the time that rows may come late."""
    at = as_ntz(as_of)
    return bucket_no(at - interval(detection_delay) if detection_delay else at, bucket) - 1


def bucket_spine(
    df: DataFrame, ts: str, bucket: str, dims: Sequence[str] = (), as_of=None, detection_delay: str | None = None
) -> DataFrame:
    """Every bucket from the first reading on, for every dimension value seen: to the last one that is complete at
    `as_of`, so that a feed that stopped shows as empty buckets. Without `as_of`, to the last reading."""
    last = F.max(bucket_no(ts, bucket)) if as_of is None else F.max(last_bucket(bucket, as_of, detection_delay))
    span = df.agg(F.min(bucket_no(ts, bucket)).alias("__lo"), last.alias("__hi"))
    every = F.when(F.col("__lo") <= F.col("__hi"), F.sequence("__lo", "__hi"))
    spine = span.filter("__lo is not null").select(F.explode(every).alias("__bucket"))
    if not dims:
        return spine
    values = df.select(*dims).distinct()
    return values.withColumn("__bucket", F.explode(span.select(every).scalar()))


def bucket_metrics(
    df: DataFrame, ts: str, bucket: str, metrics: dict[str, Column], dims: Sequence[str] = (), fill: dict | None = None,
    as_of=None, detection_delay: str | None = None,
) -> DataFrame:
    """Long metric rows (bucket, dims, metric, value) with a row for every bucket of the spine."""
    dims = list(dims)
    grouped = df.groupBy(bucket_no(ts, bucket).alias("__bucket"), *dims).agg(
        *[c.cast("double").alias(m) for m, c in metrics.items()]
    )
    spine = bucket_spine(df, ts, bucket, dims, as_of, detection_delay)
    grouped = join_null_safe(spine, grouped, ["__bucket", *dims], "left")
    fill = fill or {}
    values = [F.coalesce(F.col(m), F.lit(float(fill[m]))).alias(m) if m in fill else F.col(m) for m in metrics]
    wide = grouped.select(bucket_begin(F.col("__bucket"), bucket).alias("bucket"), *dims, *values)
    return wide.unpivot(["bucket", *dims], list(metrics), "metric", "value")


def score(
    points: DataFrame, group: Sequence[str] = (), days_back: int = DEFAULT_DAYS_BACK,
    sensitivity: float = DEFAULT_SENSITIVITY, direction: str = "both", seasonality: str | None = None,
    min_training: int = 7, ignore_spike_pct: float | None = None, ignore_drop_pct: float | None = None,
    fail_on_zero: bool = False, exclude: Column | None = None,
) -> DataFrame:
    """Judge each metric point against the `days_back` points before it (of the same weekday with seasonality).

    Allowed range: average -/+ sensitivity * sample deviation. A series without deviation flags any change. Points
    that meet `exclude` are neither trained on nor judged. Small changes can be ignored by percentage of the
    average; with `fail_on_zero` a zero is always an anomaly.
    """
    points = points if exclude is None else points.filter(~F.coalesce(exclude, F.lit(False)))
    keys = [*names(group), "metric"]
    if seasonality == "day_of_week":
        points = points.withColumn("__season", F.weekday("bucket"))
        keys = [*keys, "__season"]
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(-days_back, -1)
    points = points.withColumns(
        {
            "training_avg": F.avg("value").over(w),
            "training_stddev": F.coalesce(F.stddev_samp("value").over(w), F.lit(0.0)),
            "__n": F.count("value").over(w),
        }
    )
    reach = sensitivity * F.col("training_stddev")
    low, high = F.col("training_avg") - reach, F.col("training_avg") + reach
    if ignore_spike_pct is not None:
        high = F.greatest(high, F.col("training_avg") * (1 + ignore_spike_pct / 100.0))
    if ignore_drop_pct is not None:
        low = F.least(low, F.col("training_avg") * (1 - ignore_drop_pct / 100.0))
    over, under = F.col("value") > high, F.col("value") < low
    wanted = {"spike": over, "drop": under, "both": over | under}[direction]
    odd = wanted & (F.col("__n") >= min_training)
    if fail_on_zero:
        odd = odd | (F.col("value") == 0)
    return points.withColumns(
        {"min_value": low, "max_value": high, "is_anomalous": F.coalesce(odd, F.lit(False))}
    ).drop("__n", "__season")


def do_volume_anomalies(
    df: DataFrame, ts: str, bucket: str = "1 day", where: Column | None = None, as_of=None,
    detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """Rows per bucket, up to `as_of` (see `bucket_spine`)."""
    df = df if where is None else df.filter(where)
    count = {"row_count": F.count(F.lit(1))}
    points = bucket_metrics(df, ts, bucket, count, fill={"row_count": 0}, as_of=as_of, detection_delay=detection_delay)
    return score(points, **scoring)


def do_volume_of_runs(df: DataFrame, history: DataFrame, run_at, **scoring) -> DataFrame:
    """Row count of a table without a time column, judged by the counts of earlier runs (bucket, metric, value)."""
    now = df.agg(F.count(F.lit(1)).cast("double").alias("value"))
    now = now.select(as_ntz(run_at).alias("bucket"), F.lit("row_count").alias("metric"), "value")
    return score(history.select("bucket", "metric", "value").unionByName(now), **scoring)


def freshness_points(
    df: DataFrame, ts: str, bucket: str, as_of=None, width: str = "1 hour", detection_delay: str | None = None
) -> DataFrame:
    """Longest time without an update per bucket, in seconds: gaps are counted in the bucket where they end, and an
    open gap runs to the end of its bucket. With `as_of` the buckets go on to the last complete one, so that the gap
    of a feed that stopped grows."""
    times = df.filter(F.col(ts).isNotNull()).groupBy(F.col(ts).alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    times = chunked.with_time_chunk(times, "__at", width)
    times = chunked.previous(times, [], ["__at"], ["__at"], "__prev")
    gap = (wall_us("__at") - wall_us("__prev.__at")) / F.lit(1e6)
    spine = bucket_spine(df, ts, bucket, as_of=as_of, detection_delay=detection_delay)
    per = times.groupBy(bucket_no("__at", bucket).alias("__bucket")).agg(
        F.max(gap).alias("__gap"), F.max(wall_us("__at")).alias("__last")
    )
    joined = join_null_safe(spine, per, ["__bucket"], "left")
    w = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)  # one row per bucket
    end = wall_us(bucket_begin(F.col("__bucket") + 1, bucket))
    open_gap = (end - F.last("__last", ignorenulls=True).over(w)) / F.lit(1e6)
    value = F.greatest(F.col("__gap"), open_gap)
    return joined.select(bucket_begin(F.col("__bucket"), bucket).alias("bucket"), F.lit("freshness").alias("metric"), value.cast("double").alias("value"))


def do_freshness_anomalies(
    df: DataFrame, ts: str, bucket: str = "1 day", as_of=None, where: Column | None = None,
    detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """Only growing gaps are anomalies."""
    df = df if where is None else df.filter(where)
    points = freshness_points(df, ts, bucket, as_of, detection_delay=detection_delay)
    return score(points, **{"direction": "spike", **scoring})


def do_event_freshness(
    df: DataFrame, event_ts: str, load_ts: str, bucket: str = "1 day", where: Column | None = None, as_of=None,
    detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """Largest lag between event and load per bucket of the load time."""
    df = df if where is None else df.filter(where)
    lag = (wall_us(load_ts) - wall_us(event_ts)) / F.lit(1e6)
    points = bucket_metrics(df, load_ts, bucket, {"event_freshness": F.max(lag)}, (), {"event_freshness": 0}, as_of, detection_delay)
    return score(points, **{"direction": "spike", **scoring})


def missing(c: str) -> Column:
    """Null, blank or the text 'null'."""
    text = F.lower(F.trim(F.col(c).cast("string")))
    return F.col(c).isNull() | text.isin("", "null")


def column_monitors(c: str, numeric: bool) -> dict[str, Column]:
    """Metrics of one column, named <column>__<monitor>."""
    n = F.count(F.lit(1))
    nulls = F.count_if(F.col(c).isNull())
    found: dict[str, Column] = {
        "null_count": nulls,
        "null_percent": nulls * 100.0 / n,
        "not_null_percent": F.count(c) * 100.0 / n,
        "missing_count": F.count_if(missing(c)),
        "missing_percent": F.count_if(missing(c)) * 100.0 / n,
    }
    if numeric:
        found |= {
            "sum": F.sum(c),
            "min": F.min(c),
            "max": F.max(c),
            "average": F.avg(c),
            "zero_count": F.count_if(F.col(c) == 0),
            "zero_percent": F.count_if(F.col(c) == 0) * 100.0 / n,
            "standard_deviation": F.stddev_samp(c),
            "variance": F.var_samp(c),
        }
    else:
        size = F.length(c)
        found |= {"min_length": F.min(size), "max_length": F.max(size), "average_length": F.avg(size)}
    return {f"{c}__{name}": metric for name, metric in found.items()}


def do_column_anomalies(
    df: DataFrame, ts: str, c: str, bucket: str = "1 day", monitors: Sequence[str] | None = None,
    dims: Sequence[str] = (), where: Column | None = None, as_of=None, detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """One wide aggregation for all monitors of a column, then one scorer over the unpivoted metrics."""
    df = df if where is None else df.filter(where)
    numeric = df.schema[c].dataType.typeName() not in ("string", "boolean", "timestamp", "timestamp_ntz", "date")
    metrics = column_monitors(c, numeric)
    if monitors is not None:
        metrics = {m: metrics[f"{c}__{m}"] for m in monitors}
    points = bucket_metrics(df, ts, bucket, metrics, dims, as_of=as_of, detection_delay=detection_delay)
    return score(points, dims, **scoring)


def do_all_columns(
    df: DataFrame, ts: str, columns: Sequence[str], bucket: str = "1 day", monitors: Sequence[str] = ("null_count",),
    where: Column | None = None, as_of=None, detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """The same monitors for many columns in one scan."""
    df = df if where is None else df.filter(where)
    metrics: dict[str, Column] = {}
    for c in columns:
        numeric = df.schema[c].dataType.typeName() not in ("string", "boolean", "timestamp", "timestamp_ntz", "date")
        found = column_monitors(c, numeric)
        metrics |= {f"{c}__{m}": found[f"{c}__{m}"] for m in monitors if f"{c}__{m}" in found}
    return score(bucket_metrics(df, ts, bucket, metrics, as_of=as_of, detection_delay=detection_delay), **scoring)


def do_dimension_anomalies(
    df: DataFrame, ts: str, dims: Sequence[str], bucket: str = "1 day", where: Column | None = None, as_of=None,
    detection_delay: str | None = None, **scoring,
) -> DataFrame:
    """Row count per dimension value and bucket."""
    df = df if where is None else df.filter(where)
    count = {"dimension": F.count(F.lit(1))}
    points = bucket_metrics(df, ts, bucket, count, dims, {"dimension": 0}, as_of, detection_delay)
    return score(points, dims, **scoring)


def do_exclude_metrics(points: DataFrame, exclude: Column, group: Sequence[str] = (), **scoring) -> DataFrame:
    return score(points, group, exclude=exclude, **scoring)


def do_anomaly_range(points: DataFrame, group: Sequence[str] = (), **scoring) -> DataFrame:
    """Points with their allowed range, and whether the flag agrees with it."""
    scored = score(points, group, **scoring)
    inside = (F.col("value") >= F.col("min_value")) & (F.col("value") <= F.col("max_value"))
    return scored.withColumn("in_range", F.coalesce(inside, F.lit(True)))


def backfill_from(
    history: DataFrame, metric: str, span: DataFrame, backfill_buckets: int, bucket: str = "1 day",
    stale_buckets: int | None = None,
) -> DataFrame:
    """One row: the first bucket to recompute, given the first and last bucket of the data (`span`, one row).

    Nothing stored: all. Usually the last `backfill_buckets`; further back when the stored history ends earlier; all
    again when it ended more than `stale_buckets` ago.
    """
    step = F.lit(width_us(bucket))
    known = history.filter(F.col("metric") == metric).agg(F.max("bucket").alias("stored"))
    known = known.crossJoin(F.broadcast(span))  # one row each
    first, last, stored = wall_us("first"), wall_us("last"), wall_us("stored")
    begin = F.least(last - step * (backfill_buckets - 1), stored + step)
    if stale_buckets is not None:
        begin = F.when(last - stored > step * stale_buckets, first).otherwise(begin)
    begin = F.when(F.col("stored").isNull(), first).otherwise(begin)
    return known.select(us_to_ntz(F.greatest(begin, first)).alias("recompute_from"))


def do_metric_backfill(history: DataFrame, fresh: DataFrame, keys: Sequence[str] = ("bucket", "metric")) -> DataFrame:
    """Metric store after a partial recompute: fresh points replace stored ones of the same key."""
    return fresh.unionByName(history.join(fresh.select(*keys), list(keys), "left_anti"))


def schema_rows(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a relation. Metadata only: rows = number of columns."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def observed_schema(df: DataFrame, c: str) -> DataFrame:
    """(column_name, data_type) of the fields that occur in JSON text, over all rows; the most frequent type counts."""
    fields = F.explode(F.map_keys(F.from_json(F.col(c), "map<string,string>"))).alias("column_name")
    rows = df.select(F.try_parse_json(c).alias("__v"), fields)
    value = F.try_variant_get(F.col("__v"), F.concat(F.lit("$['"), F.col("column_name"), F.lit("']")), "variant")
    counted = rows.groupBy("column_name", F.schema_of_variant(value).alias("data_type")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column_name").agg(F.max_by("data_type", F.struct("n", "data_type")).alias("data_type"))


def do_schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed or with another type, from two `schema_rows` snapshots."""
    old = before.select("column_name", F.col("data_type").alias("pre_data_type"))
    both = old.join(after, "column_name", "full")
    change = (
        F.when(F.col("pre_data_type").isNull(), "column_added")
        .when(F.col("data_type").isNull(), "column_removed")
        .when(F.col("pre_data_type") != F.col("data_type"), "type_changed")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull())


def do_missing_count(df: DataFrame, cols: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by).agg(*[F.count_if(missing(c)).alias(f"{c}_missing") for c in cols])


def json_violations(c: str, schema: dict[str, dict]) -> Column:
    """True where JSON text breaks the field rules: type (string, number, integer, boolean), minLength, maxLength,
    required. Text that is no JSON object breaks them as well."""
    fields = F.from_json(F.col(c), "map<string,string>")
    variant = F.try_parse_json(F.col(c))
    broken = [fields.isNull()]
    kinds = {
        "string": ["STRING"],
        "integer": ["BIGINT"],
        "number": ["BIGINT", "DOUBLE", "DECIMAL"],
        "boolean": ["BOOLEAN"],
    }
    for name, rule in schema.items():
        kind = F.schema_of_variant(F.try_variant_get(variant, f"$.{name}", "variant"))
        present = F.map_contains_key(fields, name)
        if rule.get("required"):
            broken.append(~present)
        if "type" in rule:
            fits = reduce(lambda a, b: a | b, [kind.startswith(k) for k in kinds[rule["type"]]])
            broken.append(present & ~F.coalesce(fits, F.lit(False)))
        if "minLength" in rule:
            broken.append(present & (F.length(fields[name]) < rule["minLength"]))
        if "maxLength" in rule:
            broken.append(present & (F.length(fields[name]) > rule["maxLength"]))
    return reduce(lambda a, b: a | b, [F.coalesce(b, F.lit(False)) for b in broken])


def do_jsonschema(df: DataFrame, c: str, schema: dict[str, dict]) -> DataFrame:
    return df.filter(json_violations(c, schema))


def do_failed_row_count(failures: DataFrame, calc: Column | None = None) -> DataFrame:
    """Failed rows of a test: their count, or a custom aggregate such as the sum of a count column."""
    value = F.count(F.lit(1)) if calc is None else calc
    return failures.agg(F.coalesce(value, F.lit(0)).cast("long").alias("failed_row_count"))
