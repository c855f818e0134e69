"""Joins and segments along time: as-of, interval, look-back, gaps, overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.functions.timekeys import as_ntz, interval
from millstream.functions.wallclock import bucket_no, seconds_between, wall_us, width_us
from millstream.operators import chunked
from millstream.operators.chunked import CHUNK, DEFAULT_WIDTH, join_null_safe, names

NO_TIME_CHUNKS = 4096  # chunks of a key that rows without time are spread over



def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys,
    left_ts: str,
    right_ts: str,
    carry: Sequence[str],
    out: str = "match",
    strict: bool = True,
    forward: bool = False,
    tiebreak: Sequence[str] = (),
    width: str = DEFAULT_WIDTH,
    whole: bool = False,
) -> DataFrame:
    """Attach to each left row the nearest right row of the same keys before it (or after it).

    `out` is a struct of `right_ts` and `carry`, null when nothing matches. `strict` excludes equal times.
    Both sides are stacked and scanned once in time order (linear), instead of a many-to-many range join.
    Of right rows at one time the first by `tiebreak` counts. Null keys or times match nothing.
    `whole`: the left rows of a key are few, see `chunked.fits_whole`, and the right ones not many more.
    """
    keys = names(keys)
    payload = F.struct(F.col(right_ts), *carry)
    right = right.filter(F.col(right_ts).isNotNull())
    for k in keys:
        right = right.filter(F.col(k).isNotNull())
    first = F.struct(*(tiebreak or carry or [right_ts]))
    right = right.groupBy(*keys, F.col(right_ts).alias("__ts")).agg(F.min_by(payload, first).alias(out))

    # Among equal times a left row sees the right row only when the match is not strict.
    right_rank = 1 if strict != forward else 0
    stacked = left.withColumns({"__ts": F.col(left_ts), "__rank": F.lit(1 - right_rank), "__left": F.lit(True)})
    stacked = stacked.unionByName(
        right.withColumns({"__rank": F.lit(right_rank), "__left": F.lit(False)}), allowMissingColumns=True
    )
    if whole:
        filled = chunked.fill(stacked, keys, ["__ts", "__rank"], [out], backward=forward, whole=True)
        timed = F.when(F.col(left_ts).isNotNull(), F.col(out))
        return filled.filter("__left").withColumn(out, timed).drop("__ts", "__rank", "__left")
    stacked = chunked.with_time_chunk(stacked, "__ts", width)
    # Rows without time match nothing. They get chunks of their own, before all others, so that no task sorts them all.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(NO_TIME_CHUNKS))
    stacked = stacked.withColumn(CHUNK, F.coalesce(CHUNK, F.lit(-(1 << 60)) + salt))
    filled = chunked.fill(stacked, keys, ["__ts", "__rank"], [out], backward=forward)
    timed = F.when(F.col(left_ts).isNotNull(), F.col(out))
    return filled.filter("__left").withColumn(out, timed).drop("__ts", "__rank", "__left", CHUNK)


def asof_backward_join(
    left: DataFrame,
    right: DataFrame,
    keys,
    left_ts: str,
    right_ts: str,
    carry: Sequence[str] = (),
    strict: bool = True,
    max_delta: float | None = None,
    width: str = DEFAULT_WIDTH,
) -> DataFrame:
    """Correct each left time to the latest right time before it.

    Keeps the old time as `origin_<left_ts>` and adds `delta_sec`; without a match the own time stays and the
    delta is 0. `max_delta` drops rows corrected by more seconds than that.
    """
    joined = asof_join(left, right, keys, left_ts, right_ts, carry, "__match", strict=strict, width=width)
    found = F.col("__match").getField(right_ts)
    joined = joined.withColumns(
        {
            f"origin_{left_ts}": F.col(left_ts),
            "delta_sec": F.coalesce(seconds_between(found, F.col(left_ts)), F.lit(0.0)),
            **{c: F.col("__match").getField(c) for c in carry},
        }
    )
    joined = joined.withColumn(left_ts, F.coalesce(found, F.col(left_ts))).drop("__match")
    return joined if max_delta is None else joined.filter(F.col("delta_sec") <= max_delta)


def interval_join_first(
    events: DataFrame,
    intervals: DataFrame,
    keys,
    ts: str,
    start: str,
    finish: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    out: str = "match",
    width: str = DEFAULT_WIDTH,
) -> DataFrame:
    """Struct `out` of the first interval (by start) that holds the event, both ends inclusive; null if none.

    Linear for overlapping intervals too: the first interval with finish >= t is always one whose finish
    exceeds all finishes before it. Among those finishes rise with starts, so a forward as-of search on
    finish finds it; it holds t when it also starts at or before t, and otherwise no interval does.
    """
    keys = names(keys)
    order = [start, finish, *tiebreak]
    usable = intervals.filter(F.col(start).isNotNull() & F.col(finish).isNotNull())
    usable = chunked.with_time_chunk(usable, start, width)
    usable = chunked.running_max(usable, keys, order, finish, "__max")
    records = usable.filter(F.col("__max").isNull() | (F.col(finish) > F.col("__max"))).drop("__max", CHUNK)
    joined = asof_join(
        events,
        records,
        keys,
        ts,
        finish,
        [start, *carry],
        out,
        strict=False,
        forward=True,
        tiebreak=[start],
        width=width,
    )
    inside = F.col(out).getField(start) <= F.col(ts)
    return joined.withColumn(out, F.when(inside, F.col(out)))


def lagged_interval_probe(
    events: DataFrame,
    intervals: DataFrame,
    keys,
    ts: str,
    start: str,
    finish: str,
    offsets: Sequence[str],
    out_id: str,
    width: str = DEFAULT_WIDTH,
) -> DataFrame:
    """Distinct `out_id` of intervals that hold an event time minus any of the offsets.

    An interval is hit when the first probe at or after its start is not after its finish.
    """
    keys = names(keys)
    moved = F.explode(F.array(*[F.col(ts) - interval(o) for o in offsets]))
    probes = events.select(*keys, moved.alias("__probe")).distinct()
    hit = asof_join(
        intervals, probes, keys, start, "__probe", [], "__hit", strict=False, forward=True, width=width
    ).filter(F.col("__hit.__probe") <= F.col(finish))
    return hit.select(out_id).distinct()


def range_pairs(
    points: DataFrame,
    spans: DataFrame,
    keys,
    ts: str,
    start: str,
    finish: str,
    bucket: str,
    closed: str = "both",
    how: str = "inner",
) -> DataFrame:
    """All (span, point) pairs with the point inside the span, joined on (keys, time bucket).

    Spans are copied into the buckets they touch, so choose `bucket` near the usual span length. Candidate
    pairs stay near the true pairs, and a hot key spreads over its buckets. `how='left'` keeps spans
    without points.
    """
    keys = names(keys)
    first, last = bucket_no(start, bucket), bucket_no(finish, bucket)
    placed = spans.withColumn(
        "__bucket", F.explode_outer(F.when(last >= first, F.sequence(first, F.greatest(first, last))))
    )
    renamed = points.select(
        *[F.col(k).alias(f"__p_{k}") for k in keys],
        bucket_no(ts, bucket).alias("__p_bucket"),
        *[c for c in points.columns if c not in keys],
    )
    condition = (F.col("__bucket") == F.col("__p_bucket")) & (F.col(ts) >= F.col(start))
    condition &= (F.col(ts) <= F.col(finish)) if closed == "both" else (F.col(ts) < F.col(finish))
    for k in keys:
        condition &= placed[k] == renamed[f"__p_{k}"]
    joined = placed.join(renamed, condition, how)
    return joined.drop("__bucket", "__p_bucket", *[f"__p_{k}" for k in keys])


#: Each node of the time tree has 4 children; a node of this level is longer than all times together.
_CHILD_BITS, _TOP_LEVEL = 2, 20


def _nodes(first: Column, last: Column) -> Column:
    """(level, node): the fewest whole nodes of the time tree that make up the buckets first to last."""
    kind = "array<struct<level:int,node:bigint>>"
    children = 1 << _CHILD_BITS

    def run(level: Column, lo: Column, hi: Column) -> Column:
        """Nodes lo to hi - 1 of a level."""
        each = F.transform(F.sequence(lo, hi - 1), lambda n: F.struct(level.cast("int").alias("level"), n.alias("node")))
        return F.when(lo < hi, each).otherwise(F.array().cast(kind))

    def step(x: Column, level: Column) -> Column:
        up = F.call_function("shiftright", x["lo"] + (children - 1), F.lit(_CHILD_BITS))
        down = F.call_function("shiftright", x["hi"], F.lit(_CHILD_BITS))
        # Parents that lie wholly inside go up; what is left of them and right of them stays on this level.
        inner = up < down
        left = run(level, x["lo"], F.when(inner, up * children).otherwise(x["hi"]))
        right = run(level, F.when(inner, down * children).otherwise(x["hi"]), x["hi"])
        return F.struct(F.when(inner, up).otherwise(F.lit(0)).cast("long").alias("lo"), F.when(inner, down).otherwise(F.lit(0)).cast("long").alias("hi"), F.concat(x["nodes"], left, right).alias("nodes"))

    begin = F.struct(first.cast("long").alias("lo"), (last + 1).cast("long").alias("hi"), F.array().cast(kind).alias("nodes"))
    # A level has at most a fourth of the nodes of the one below, so short spans are done after few levels.
    levels = F.floor(F.log2(F.greatest(last - first + 1, F.lit(1)).cast("double")) / _CHILD_BITS) + 1
    made = F.aggregate(F.sequence(F.lit(0), F.least(levels.cast("int"), F.lit(_TOP_LEVEL))), begin, step, lambda x: x["nodes"])
    return F.when(last >= first, made)


def tree_pairs(
    points: DataFrame, spans: DataFrame, keys, ts: str, start: str, finish: str, bucket: str, closed: str = "both"
) -> DataFrame:
    """All (span, point) pairs with the point inside the span, as `range_pairs`, for spans of any length.

    A span is cut into nodes of a time tree over buckets, whose number grows as the logarithm of its length: one that is
    open until the year 9999 has under 100. A point looks up the node that holds it on each level that spans of its key
    use. closed: both, left (without the finish) or neither.
    """
    keys = names(keys)
    own = [f"__s_{k}" for k in keys]
    nodes = spans.withColumn("__n", F.explode(_nodes(bucket_no(start, bucket), bucket_no(finish, bucket))))
    nodes = nodes.select("*", F.col("__n.level").alias("__level"), F.col("__n.node").alias("__node")).drop("__n").withColumnsRenamed(dict(zip(keys, own)))
    levels = nodes.select(*own, F.col("__level").alias("__at")).distinct()
    # Neither side is ever broadcast: Spark takes rows that were exploded to be as few as those before it.
    rows = points.hint("merge").join(levels, [points[k] == levels[o] for k, o in zip(keys, own)]).drop(*own)
    rows = rows.withColumn("__place", F.call_function("shiftright", bucket_no(ts, bucket).cast("long"), F.col("__at") * _CHILD_BITS))
    condition = (F.col("__level") == F.col("__at")) & (F.col("__node") == F.col("__place"))
    condition &= (F.col(ts) > F.col(start)) if closed == "neither" else (F.col(ts) >= F.col(start))
    condition &= (F.col(ts) <= F.col(finish)) if closed == "both" else (F.col(ts) < F.col(finish))
    for k, o in zip(keys, own):
        condition &= rows[k] == nodes[o]
    return nodes.hint("merge").join(rows, condition).drop("__level", "__node", "__at", "__place", *own)


def lookback_interval_join(
    events: DataFrame,
    series: DataFrame,
    keys,
    event_id,
    ts: str,
    series_ts: str,
    value: str,
    lookback: str,
    bucket: str | None = None,
) -> DataFrame:
    """Per event the readings in [ts - lookback, ts], as a time-ordered array `readings`; empty when none.

    The array is bounded by the look-back window.
    """
    spans = events.withColumn("__from", F.col(ts) - interval(lookback))
    pairs = range_pairs(
        series.select(*names(keys), series_ts, value), spans, keys, series_ts, "__from", ts, bucket or lookback
    )
    reading = F.struct(series_ts, value)
    lists = pairs.groupBy(*names(event_id)).agg(F.array_sort(F.collect_list(reading)).alias("readings"))
    joined = join_null_safe(events, lists, names(event_id), "left")
    empty = F.array().cast(lists.schema["readings"].dataType)
    return joined.withColumn("readings", F.coalesce("readings", empty))


def lookback_stats(
    events: DataFrame, series: DataFrame, keys, event_id, ts: str, series_ts: str, value: str, lookback: str
) -> DataFrame:
    """Count, mean, min and max of the look-back readings per event: (0, null, null, null) when none."""
    spans = events.withColumn("__from", F.col(ts) - interval(lookback))
    pairs = range_pairs(
        series.select(*names(keys), series_ts, value), spans, keys, series_ts, "__from", ts, lookback
    )
    stats = pairs.groupBy(*names(event_id)).agg(
        F.count(value).alias("reading_count"),
        F.avg(value).alias("reading_avg"),
        F.min(value).alias("reading_min"),
        F.max(value).alias("reading_max"),
    )
    joined = join_null_safe(events, stats, names(event_id), "left")
    return joined.withColumn("reading_count", F.coalesce("reading_count", F.lit(0)))


def cycle_window_join(
    series: DataFrame, cycles: DataFrame, entity, ts: str, start: str, end: str, closed: str = "both",
    bucket: str = "10 minutes",
) -> DataFrame:
    """Readings inside each cycle; with `closed='both'` a reading on a shared boundary is in two cycles.

    Cycles may be as long as they like, also open until a far time; `bucket` is best near the length of a short one.
    """
    return tree_pairs(series, cycles, entity, ts, start, end, bucket, closed)


def overlap_trim(
    df: DataFrame, keys, start: str, finish: str, as_of=None, tiebreak: Sequence[str] = (), width: str = DEFAULT_WIDTH
) -> DataFrame:
    """Cut each interval at the next start of its key. A missing finish is `as_of` first.

    Starts never change, so one pass equals repeated trimming.
    """
    keys = names(keys)
    if as_of is not None:
        df = df.withColumn(finish, F.coalesce(F.col(finish), as_ntz(as_of)))
    chunks = chunked.with_time_chunk(df, start, width)
    chunks = chunked.following(chunks, keys, [start, finish, *tiebreak], [start], "__next")
    following_start = F.col("__next").getField(start)
    cut = F.when(F.col(finish) > following_start, following_start).otherwise(F.col(finish))
    return chunks.withColumn(finish, cut).drop("__next", CHUNK)


def gap_segments(
    df: DataFrame,
    entity,
    ts: str,
    gap: str,
    tiebreak: Sequence[str] = (),
    out: str = "segment",
    width: str = DEFAULT_WIDTH,
) -> DataFrame:
    """Number the stretches of a series: a new one starts when the distance to the row before reaches `gap`.

    The summary of a chunk holds its first and last time and its inner gaps, so one scan of the chunks gives
    every chunk its starting number.
    """
    keys = names(entity)
    order = [ts, *tiebreak]
    limit = F.lit(width_us(gap))
    df = chunked.with_keys(chunked.with_time_chunk(df, ts, width).withColumn("__us", wall_us(ts)), keys)
    local = chunked.local_window(keys, order)
    apart = F.col("__us") - F.lag("__us").over(local) >= limit
    df = df.withColumn("__gap", F.coalesce(apart.cast("long"), F.lit(0)))
    parts = {"__first": F.min("__us"), "__last": F.max("__us"), "__gaps": F.sum("__gap")}

    def edges(w):
        return {"__joins": F.coalesce((F.col("__first") - F.lag("__last").over(w) >= limit).cast("long"), F.lit(0))}

    def base(w):
        so_far = F.sum(F.col("__joins") + F.col("__gaps")).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return {"__base": F.coalesce(so_far, F.lit(0)) + F.col("__joins")}

    df = chunked.carry(df, keys, parts, edges, base)
    here = F.sum("__gap").over(local.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn(out, F.col("__base") + here)
    return chunked.bare(df, keys, "__base", "__joins", "__gap", "__us", CHUNK)


def busy_segments(df: DataFrame, entity, segment: str, value: str, idle: float) -> DataFrame:
    """Drop segments in which no reading exceeds `idle`."""
    keys = [*names(entity), segment]
    busy = df.groupBy(*keys).agg(F.max(value).alias("__peak")).filter(F.col("__peak") > idle).select(*keys)
    return df.join(busy, keys, "left_semi")


def fill_series(df: DataFrame, keys, ts: str, cols, tiebreak=(), backward=False, width=DEFAULT_WIDTH, suffix=""):
    """Forward (or backward) fill per key."""
    chunks = chunked.with_time_chunk(df, ts, width)
    return chunked.fill(chunks, keys, [ts, *tiebreak], cols, backward, suffix).drop(CHUNK)


def ffill_bfill(df: DataFrame, keys, ts: str, cols, tiebreak=(), width=DEFAULT_WIDTH) -> DataFrame:
    """Forward fill, then fill what leads the first valid value; rows with no signal at all are dropped first.

    A row without a valid value up to it takes the first valid value of its key, which is a total of the key.
    """
    keys, order = names(keys), [ts, *tiebreak]
    df = df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())
    df = chunked.with_time_chunk(df, ts, width)
    parts = {}
    for i, c in enumerate(cols):
        at = F.when(F.col(c).isNotNull(), chunked.order_struct(order))
        parts |= {f"__v{i}": F.max_by(c, at), f"__f{i}": F.min_by(c, at)}

    def scan(w):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found = {f"__c{i}": F.last(f"__v{i}", ignorenulls=True).over(before) for i in range(len(cols))}
        return found | {f"__e{i}": F.first(f"__f{i}", ignorenulls=True).over(whole) for i in range(len(cols))}

    df = chunked.carry(df, keys, parts, scan)
    frame = chunked.local_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(frame), F.col(f"__c{i}"), F.col(f"__e{i}"))
        for i, c in enumerate(cols)
    }
    return chunked.bare(df.withColumns(filled), keys, CHUNK, *[f"__{x}{i}" for i in range(len(cols)) for x in "ce"])


def interpolate_linear(df: DataFrame, keys, ts: str, c: str, out: str, tiebreak=(), width=DEFAULT_WIDTH) -> DataFrame:
    """Fill nulls on the line between the neighbours by row position; leading nulls stay, trailing repeat."""
    keys, order = names(keys), [ts, *tiebreak]
    df = chunked.with_keys(chunked.with_time_chunk(df, ts, width), keys)
    local = chunked.local_window(keys, order)
    df = df.withColumn("__rn", F.row_number().over(local).cast("long"))
    df = df.withColumn("__known", F.when(F.col(c).isNotNull(), F.struct(F.col("__rn").alias("rn"), F.col(c).alias("v"))))
    known_rn = F.when(F.col(c).isNotNull(), F.col("__rn"))
    parts = {
        "__n": F.count(F.lit(1)),
        "__last": F.max_by("__known", known_rn),
        "__first": F.min_by("__known", known_rn),
    }

    def base(w):
        so_far = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1))
        return {"__base": F.coalesce(so_far, F.lit(0))}

    def placed(x: Column) -> Column:
        return F.when(x.isNotNull(), F.struct((F.col("__base") + x["rn"]).alias("rn"), x["v"].alias("v")))

    def neighbours(w):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        after = w.rowsBetween(1, Window.unboundedFollowing)
        return {
            "__far_before": F.last(placed(F.col("__last")), ignorenulls=True).over(before),
            "__far_after": F.first(placed(F.col("__first")), ignorenulls=True).over(after),
        }

    df = chunked.carry(df, keys, parts, base, neighbours)
    near_before = F.last("__known", ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0))
    near_after = F.first("__known", ignorenulls=True).over(local.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumns({"__near_before": near_before, "__near_after": near_after})
    before = F.coalesce(placed(F.col("__near_before")), F.col("__far_before"))
    after = F.coalesce(placed(F.col("__near_after")), F.col("__far_after"))
    step = (F.col("__base") + F.col("__rn") - before["rn"]) / (after["rn"] - before["rn"])
    line = before["v"] + (after["v"] - before["v"]) * step
    value = F.when(F.col(c).isNotNull(), F.col(c)).when(before.isNotNull(), F.coalesce(line, before["v"]))
    helpers = ["__rn", "__known", "__base", "__far_before", "__far_after", "__near_before", "__near_after", CHUNK]
    return chunked.bare(df.withColumn(out, value), keys, *helpers)


def resample_linear(df: DataFrame, keys, ts: str, cols: Sequence[str], n: int, tiebreak=(), width=DEFAULT_WIDTH):
    """Each key's series on `n` evenly spaced points: one row (keys, point, cols) per point.

    Every row emits the points between itself and its successor, so no lookup join is needed.
    """
    keys, order = names(keys), [ts, *tiebreak]
    df = chunked.with_time_chunk(df.select(*keys, *order, *cols), ts, width)
    value = F.struct(*cols)

    def scan(w):
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return {
            "__base": F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
            "__total": F.sum("__n").over(whole),
            "__after": F.lead("__first").over(w),
        }

    parts = {"__n": F.count(F.lit(1)), "__first": F.min_by(value, chunked.order_struct(order))}
    df = chunked.carry(df, keys, parts, scan)
    local = chunked.local_window(keys, order)
    df = df.withColumns(
        {
            "__rn": F.row_number().over(local).cast("long") + F.coalesce(F.col("__base"), F.lit(0)),
            "__next": F.coalesce(F.lead(value).over(local), F.col("__after")),
        }
    )
    index, last = F.col("__rn") - 1, F.col("__total") - 1
    only = F.col("__total") == 1
    first_point = F.when(only, F.lit(0)).otherwise(F.ceil(index * (n - 1) / last)).cast("long")
    next_first = F.when(index == last, F.lit(n)).otherwise(F.ceil((index + 1) * (n - 1) / last)).cast("long")
    points = F.when(next_first > first_point, F.sequence(first_point, next_first - 1))
    df = df.withColumn("point", F.explode(points))
    part = F.when(only, F.lit(0.0)).otherwise(F.col("point") * last / F.lit(float(n - 1)) - index)
    values = {
        c: F.col(c) + F.coalesce((F.col("__next").getField(c) - F.col(c)) * part, F.lit(0.0)) for c in cols
    }
    return df.withColumns(values).select(*keys, F.col("point").cast("int").alias("point"), *cols)


def point_vectors(points: DataFrame, keys, cols: Sequence[str], out: str = "vector") -> DataFrame:
    """Array per key: all points of the first signal, then of the next one. Bounded by the point count."""
    parts = [F.array_sort(F.collect_list(F.struct("point", F.col(c).alias("v")))) for c in cols]
    parts = [F.transform(p, lambda x: x["v"]) for p in parts]
    return points.groupBy(*names(keys)).agg(F.concat(*parts).alias(out))


def lead_dwell(df: DataFrame, keys, group, ts: str, as_of) -> DataFrame:
    """First time per (keys, group), the time of the key's next group (`as_of` for the last) and the dwell seconds."""
    keys, group = names(keys), names(group)
    seen = df.groupBy(*keys, *group).agg(F.min(ts).alias("now_dt"))
    seen = chunked.with_time_chunk(seen, "now_dt", "1 day")
    seen = chunked.following(seen, keys, ["now_dt", *group], ["now_dt"], "__next")
    after = F.coalesce(F.col("__next.now_dt"), as_ntz(as_of))
    return seen.withColumns(
        {"next_dt": after, "dwell_sec": seconds_between(F.col("now_dt"), after)}
    ).drop("__next", CHUNK)


def lag_gap_days(df: DataFrame, keys, day: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Previous day of the key and days since it."""
    df = df.withColumn(CHUNK, F.year(day).cast("long") * 12 + F.month(day))
    df = chunked.previous(df, keys, [day, *tiebreak], [day], "__prev")
    before = F.col("__prev").getField(day)
    return df.withColumns({"previous_day": before, "gap_days": F.datediff(day, before)}).drop("__prev", CHUNK)


def sequence_no(df: DataFrame, day: str, order, prefix: str, out: str = "no", chunk: Column | None = None) -> DataFrame:
    """Identifier prefix_yyyyMMdd_n, counting per day in `order`."""
    order = names(order)
    text = F.date_format(day, "yyyyMMdd")
    df = df.withColumns({"__day": text, CHUNK: chunk if chunk is not None else bucket_no(order[0], DEFAULT_WIDTH)})
    df = chunked.numbered(df, ["__day"], order, "__no")
    return df.withColumn(out, F.concat_ws("_", F.lit(prefix), "__day", F.col("__no").cast("string"))).drop(
        "__day", "__no", CHUNK
    )
