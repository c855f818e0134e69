"""Group aggregations: pivots, roll-ups, time buckets, nested results, deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.functions.wallclock import bucket_start, col
from millstream.operators.chunked import names


def rollup_grouping_filter(
    df: DataFrame, dims: Sequence[str], keep: int, measures: dict[str, Column], label: str, total_label: str = "Total"
) -> DataFrame:
    """ROLLUP over `dims`, keeping the levels with the first `keep` dimensions and the grand total.

    `label` is the text of the kept dimension, `total_label` on the grand total row.
    """
    rolled = df.rollup(*dims).agg(
        *[c.alias(n) for n, c in measures.items()], F.grouping_id().alias("__gid")
    )
    level = (1 << (len(dims) - keep)) - 1
    everything = (1 << len(dims)) - 1
    kept = rolled.filter(F.col("__gid").isin(level, everything))
    name = F.when(F.col("__gid") == everything, F.lit(total_label)).otherwise(F.col(dims[0]).cast("string"))
    return kept.withColumn(label, name).select(label, *measures)


def conditional_pivot_sum(
    df: DataFrame, keys, pivot_col: str, values: dict[object, str], measures: Sequence[str]
) -> DataFrame:
    """One sum per (value, measure), 0 where absent; columns are `<value name>_<measure>`."""
    sums = [
        F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(m)).otherwise(0)).alias(f"{n}_{m}")
        for v, n in values.items()
        for m in measures
    ]
    return df.groupBy(*names(keys)).agg(*sums)


def pivot_first(df: DataFrame, index, tag: str, value: str, tags: dict[str, str], order: str) -> DataFrame:
    """Long to wide: per index row the first non-null value of each tag, first by `order`.

    Plain conditional aggregates, so no pass is spent on finding the tag values.
    """
    firsts = [
        F.min_by(F.col(value), F.when((F.col(tag) == t) & F.col(value).isNotNull(), F.col(order))).alias(n)
        for t, n in tags.items()
    ]
    return df.groupBy(*names(index)).agg(*firsts)


def pivot_agg(
    df: DataFrame, keys, c: str, values: Sequence[object], agg: Callable[[Column], Column] = F.sum, then="1",
    prefix: str = "", suffix: str = "", otherwise=0,
) -> DataFrame:
    """Aggregate of `then` per listed value of `c`, `otherwise` elsewhere."""
    cells = [
        agg(F.when(F.col(c) == F.lit(v), F.expr(str(then))).otherwise(F.lit(otherwise))).alias(f"{prefix}{v}{suffix}")
        for v in values
    ]
    return df.groupBy(*names(keys)).agg(*cells)


def pivot_count(df: DataFrame, keys, c: str, values: Sequence[object], prefix: str = "") -> DataFrame:
    return pivot_agg(df, keys, c, values, F.sum, "1", prefix)


def unpivot(df: DataFrame, ids, cols: Sequence[str], name: str = "field_name", value: str = "value") -> DataFrame:
    """Columns to rows; values as text, since the columns may differ in type."""
    ids = names(ids)
    texts = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return texts.unpivot(ids, list(cols), name, value)


READING = "decimal(18,6)"


def decimal_mean(c: str, digits: int) -> Column:
    """Mean of exact decimals, rounded half up; sums do not depend on the order of rows."""
    exact = F.col(c).cast(READING)
    return F.round(F.sum(exact) / F.count(exact), digits).cast("double")


def hourly_sensor_stats(
    df: DataFrame, entity: str, ts: str, metrics: Sequence[str], exclude: Sequence = (), digits: int = 2
) -> DataFrame:
    """max, min and rounded avg of each metric per (ymd, hour, sensor); text metrics are read as numbers and
    rows without any valid reading are dropped."""
    numeric = df.withColumns({m: F.nullif(F.trim(F.col(m).cast("string")), F.lit("")).try_cast(READING) for m in metrics})
    valid = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in metrics])
    numeric = numeric.filter(valid)
    if exclude:
        numeric = numeric.filter(~F.col(entity).isin(list(exclude)))
    aggs = []
    for m in metrics:
        aggs += [
            F.round(F.max(m), digits).cast("double").alias(f"{m}_max"),
            F.round(F.min(m), digits).cast("double").alias(f"{m}_min"),
            decimal_mean(m, digits).alias(f"{m}_avg"),
        ]
    return numeric.groupBy(
        F.date_format(ts, "yyyyMMdd").alias("ymd"), F.hour(ts).alias("hour"), F.col(entity)
    ).agg(*aggs)


def tumbling_avg(
    df: DataFrame, entity, ts: str, metrics: Sequence[str], width: str = "10 minutes", src_tz: str | None = None,
    dst_tz: str | None = None, digits: int = 2,
) -> DataFrame:
    """Rounded average per fixed-width bucket, after moving the time from one zone to another."""
    at = F.col(ts)
    if src_tz and dst_tz:
        at = F.convert_timezone(F.lit(src_tz), F.lit(dst_tz), at.cast("timestamp_ntz"))
    return (
        df.withColumn("__at", at)
        .groupBy(*names(entity), bucket_start("__at", width).alias("bucket_ts"))
        .agg(*[decimal_mean(m, digits).alias(f"{m}_avg") for m in metrics])
    )


LEVELS = {
    "factory": ["factory"],
    "building": ["factory", "building"],
    "floor": ["factory", "building", "floor"],
    "location": ["factory", "building", "floor", "loc_id", "area"],
}


def aggregation_level(factory=None, building=None, floor=None, location_id=None) -> str:
    """Level of the answer: the coarsest one the request pins down."""
    if factory and not building:
        return "factory"
    if factory and building and not location_id:
        return "building" if floor is None else "floor"
    return "location"


def time_unit(start_key: str, end_key: str) -> str:
    """yyyy keys give months, yyyyMM keys days (months from a distance of four months), longer keys hours."""
    if len(start_key) == 4:
        return "monthly"
    if len(start_key) == 6:
        months = (int(end_key[:4]) - int(start_key[:4])) * 12 + int(end_key[4:6]) - int(start_key[4:6])
        return "monthly" if months >= 4 else "daily"
    return "hourly"


def multi_level_time_agg(
    df: DataFrame, locations: DataFrame, start_key: str, end_key: str, metrics: Sequence[str], sensor: str = "sensor_id",
    factory=None, building=None, floor=None, location_id=None, area=None, start_hour=None, end_hour=None, suffix: int = 4,
) -> DataFrame:
    """Roll hourly sensor rows (ymd, hour, sensor, <m>_max/min/avg) up to the requested place and time unit.

    Maxima of maxima, minima of minima, and the unweighted mean of the averages. `locations` has a row per
    sensor suffix (`loc_id` = last `suffix` characters of the sensor).
    """
    level = aggregation_level(factory, building, floor, location_id)
    unit = time_unit(start_key, end_key)
    key = F.substring("ymd", 1, len(start_key)) if len(start_key) < 8 else F.col("ymd")
    rows = df.filter((key >= start_key) & (key <= end_key))
    if start_hour is not None and end_hour is not None:
        rows = rows.filter(F.col("hour").between(int(start_hour), int(end_hour)))
    wanted = {"factory": factory, "building": building, "floor": floor, "loc_id": location_id, "area": area}
    for name, value in wanted.items():
        if value is not None:
            locations = locations.filter(F.col(name) == F.lit(value))
    rows = rows.withColumn("loc_id", F.expr(f"right({sensor}, {int(suffix)})")).join(locations, "loc_id", "inner")
    when = {
        "hourly": [F.col("ymd"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour")],
        "daily": [F.col("ymd"), F.lit("00").alias("hour")],
        "monthly": [F.substring("ymd", 1, 6).alias("ymd"), F.lit("00").alias("hour")],
    }[unit]
    aggs = []
    for m in metrics:
        aggs += [
            F.max(f"{m}_max").alias(f"{m}_max"),
            F.min(f"{m}_min").alias(f"{m}_min"),
            decimal_mean(f"{m}_avg", 2).alias(f"{m}_avg"),
        ]
    return rows.groupBy(*when, *LEVELS[level]).agg(*aggs)


def hour_fallback_check(df: DataFrame, hour: str, start_hour: int, end_hour: int) -> DataFrame:
    """Rows of the hour range, or all rows when the range is empty. The probe stops at the first hit."""
    wanted = df.filter(F.col(hour).between(start_hour, end_hour))
    return df if wanted.isEmpty() else wanted


def status_counts(df: DataFrame, levels: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*levels).agg(F.count(F.lit(1)).alias(out))


def grouping_sets_counts(df: DataFrame, sets: Sequence[Sequence[str]], out: str = "cnt") -> DataFrame:
    """Counts of several hierarchies in one pass; `level` names the grouping set by its columns."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(
        F.count(F.lit(1)).alias(out), F.grouping_id().alias("__gid")
    )
    label = F.when(F.lit(False), F.lit(""))
    for s in sets:
        gid = sum(0 if c in s else 1 << (len(cols) - 1 - i) for i, c in enumerate(cols))
        label = label.when(F.col("__gid") == gid, F.lit("/".join(s)))
    return grouped.select(label.alias("level"), *cols, out)


def nested_hierarchy(df: DataFrame, levels: Sequence[str], leaf: Sequence[str], unknown: str = "UNKNOWN") -> DataFrame:
    """One row per top-level value with nested arrays below it, innermost = distinct sorted `leaf` structs.

    Missing names become `unknown`. Built level by level on the distinct hierarchy (a dimension), never on facts.
    """
    dims = df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias(c) for c in levels], *leaf
    ).distinct()
    tree = dims.groupBy(*levels).agg(F.array_sort(F.collect_list(F.struct(*leaf))).alias("children"))
    for depth in range(len(levels) - 1, 0, -1):
        child = F.struct(F.col(levels[depth]).alias("name"), F.col("children"))
        tree = tree.groupBy(*levels[:depth]).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(levels[depth]).alias("k"), child.alias("v")))),
                lambda x: x["v"],
            ).alias("children")
        )
    return tree


def nested_readings(
    df: DataFrame, keys, item_cols: Sequence[str], per: Sequence[Column] = (), out: str = "items"
) -> DataFrame:
    """Readings as ordered arrays per key. `per` bounds an array (for example a day), so a long-lived sensor
    becomes many rows and not one endless array."""
    return df.groupBy(*names(keys), *per).agg(F.array_sort(F.collect_list(F.struct(*item_cols))).alias(out))


def filtered_count_and_list(df: DataFrame, key: str, pred: Column, item_cols: Sequence[str]) -> DataFrame:
    """Per key the number of rows that meet `pred` and their ordered list. Keys without hits stay, with an empty
    list. `df` holds one row per device and key, so a list is at most the number of devices."""
    item = F.when(pred, F.struct(*item_cols))
    return df.groupBy(key).agg(
        F.count_if(pred).alias("hit_count"), F.array_sort(F.collect_list(item)).alias("hits")
    )


def wip_counts(df: DataFrame, op: str, qty: str, where: Column) -> DataFrame:
    """Count, quantity and a 'count(quantity)' label per operation."""
    grouped = df.filter(where).groupBy(op).agg(F.count(F.lit(1)).alias("cnt"), F.sum(qty).cast("long").alias("qty"))
    label = F.concat(F.col("cnt").cast("string"), F.lit("("), F.col("qty").cast("string"), F.lit(")"))
    return grouped.withColumn("label", label)


def monthly_usage(df: DataFrame, keys, day: str, qty: str) -> DataFrame:
    return df.groupBy(*names(keys), F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(qty).alias("usage_qty")
    )


def yearly_performance(df: DataFrame, unit, ymd: str, qty: str) -> DataFrame:
    """Sum per unit and year of a yyyyMMdd key."""
    return df.groupBy(*names(unit), F.substring(ymd, 1, 4).alias("year")).agg(F.sum(qty).alias("total_qty"))


def replacement_cycle(gaps: DataFrame, keys, gap: str, min_count: int = 2) -> DataFrame:
    """Mean days between replacements for keys with more than `min_count` gaps, rounded half to even."""
    cycle = F.bround(F.avg(gap), 0).cast("long")
    grouped = gaps.groupBy(*names(keys)).agg(cycle.alias("cycle_dt"), F.count(gap).alias("__n"))
    return grouped.filter(F.col("__n") > min_count).drop("__n")


def positive_min_max(df: DataFrame, keys, c: str) -> DataFrame:
    return df.groupBy(*names(keys)).agg(
        F.min(F.when(F.col(c) > 0, F.col(c))).alias("min_qty"), F.max(c).alias("max_qty")
    )


def zero_fill_days(df: DataFrame, day: str, dims, start, end, measures: Sequence[str]) -> DataFrame:
    """Every day of [start, end] for every dimension row seen; absent measures are 0.

    The dimension rows carry the sequence of days; rows are dims x days, as asked for.
    """
    dims = names(dims)
    sums = df.groupBy(*dims, F.col(day).alias("__d")).agg(*[F.sum(m).alias(m) for m in measures])
    spine = df.select(*dims).distinct().withColumn("__d", F.explode(F.sequence(col(start), col(end))))
    filled = spine.join(sums, [*dims, "__d"], "left")
    return filled.select(
        F.col("__d").alias(day), *dims, *[F.coalesce(m, F.lit(0)).alias(m) for m in measures]
    )


def first_event_per_id(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Earliest row per id: one `min_by` over the whole row, combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(key, "__row.*")


def latest_per_key(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of the latest row per key: one `max_by`, combined before the shuffle."""
    return (
        df.groupBy(*names(keys))
        .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__row"))
        .select(*names(keys), "__row.*")
    )


def first_per_slot(
    df: DataFrame, entity, ts: str, cols: Sequence[str], width: str = "30 minutes", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """First reading of each sensor in each time slot."""
    slot = bucket_start(ts, width).alias("slot")
    return (
        df.groupBy(*names(entity), slot)
        .agg(F.min_by(F.struct(*cols), F.struct(ts, *tiebreak)).alias("__row"))
        .select(*names(entity), "slot", "__row.*")
    )


def topk_per_group(df: DataFrame, keys, order: Sequence[Column], k: int, out: str = "rn") -> DataFrame:
    """First `k` rows per group. The filter on the row number lets Spark cut groups to `k` before the shuffle."""
    w = Window.partitionBy(*names(keys)).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def distinct_dedup(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """One row per key, first by `order`."""
    keys = names(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*")


def get_column_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct values, most frequent first."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), c)


def get_single_value(df: DataFrame, value: Column, out: str = "value") -> Column:
    """Scalar subquery: the aggregate `value` over `df`, usable as a column elsewhere."""
    return df.agg(value.alias(out)).scalar()


def star_except(df: DataFrame, drop: Sequence[str], prefix: str = "", suffix: str = "") -> DataFrame:
    kept = [c for c in df.columns if c not in set(drop)]
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in kept])
