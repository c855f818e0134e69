"""Streaming forms of the batch operators.

Every stream bounds its state with a watermark or keeps one small state per key. Files arrive through a file source;
`run_append`, `run_updates` and `stream_late_data` drive a query to the end of the available input. Given the `place` of an
earlier run they go on where it stopped, and each row counts once: checkpoint and results lie there, and a batch counts
when its commit record is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millstream.functions.spc_constants import SIGMAS, spc_coefficients
from millstream.functions.wallclock import width_us
from millstream.operators import alerts as al
from millstream.operators.chunked import names
from millstream.session import shared_path
from millstream.streaming.ordered import Columns, in_time_order


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str, ts: str = "ts", batch_bytes: int = 4 << 30
) -> DataFrame:
    """Parquet files as a stream; the event time becomes a timestamp, which watermarks need.

    `batch_bytes` bounds a batch.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxBytesPerTrigger", batch_bytes)
    stream = reader.parquet(folder)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def _finish(writer: DataStreamWriter, spark: SparkSession, settings: dict[str, str]) -> None:
    """Runs a query over all available input; `settings` hold for this query only."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()


def run_append(stream: DataFrame, label: str, place: str | None = None, settings: dict[str, str] | None = None) -> DataFrame:
    """Process all available input into a Parquet table and read it back.

    place: a folder all executors share. A run with the place of an earlier one goes on where that one stopped, and each
    row is in the table once, also if that run was killed. Without it the run has a folder of its own.
    """
    spark = stream.sparkSession
    out = place or shared_path(spark, label)
    writer = stream.writeStream.format("parquet").outputMode("append")
    _finish(writer.option("checkpointLocation", f"{out}/_chk").option("path", f"{out}/data"), spark, settings or {})
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int, str], dict[str, object]], out: str, mode: str, record: str) -> DataFrame:
    """Process all available input batch by batch; the commit records.

    write(batch, epoch, out) writes folders of that epoch below `out`, replacing what is there, and returns the values of its
    commit record (types `record`, DDL), which is written last. An epoch with a record isn't written again, and only such epochs
    count for `committed`; so a run that is killed between two writes leaves no half of a batch, and its batch is done
    anew by the next run.
    """
    spark = stream.sparkSession

    def once(batch: DataFrame, epoch: int) -> None:
        if commit_record(spark, out, epoch) is None:
            values = write(batch, epoch, out)
            row = spark.createDataFrame([tuple(values.values())], T.StructType.fromDDL(record)).coalesce(1)
            row.write.mode("overwrite").parquet(f"{out}/commits/epoch={epoch}")

    _finish(stream.writeStream.outputMode(mode).foreachBatch(once).option("checkpointLocation", f"{out}/_chk"), spark, {})
    return spark.read.parquet(f"{out}/commits")


def commit_record(spark: SparkSession, out: str, epoch: int) -> Row | None:
    """What a committed epoch of `run_batches` recorded; None if it isn't committed."""
    try:
        return spark.read.parquet(f"{out}/commits/epoch={epoch}").first()
    except AnalysisException:  # there is no such folder
        return None


def committed(spark: SparkSession, out: str, folder: str) -> DataFrame:
    """The rows of all committed epochs in a folder below `out`, with their `epoch`."""
    done = spark.read.parquet(f"{out}/commits").select("epoch")
    return spark.read.parquet(f"{out}/{folder}").join(done, "epoch", "left_semi")


def run_updates(
    stream: DataFrame, keys: Sequence[str], label: str, each: Callable[[DataFrame], DataFrame] | None = None, place: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Process all available input of an aggregating stream in update mode; the latest version per key.

    `each` transforms a batch, for example to join it with dimension tables. place: as in `run_append`.
    unique: a batch has each key once at most, so that the rows of a single batch are the latest as they are.
    """
    spark = stream.sparkSession
    out = place or shared_path(spark, label)

    def write(batch: DataFrame, epoch: int, out: str) -> dict[str, object]:
        shaped = batch if each is None else each(batch)
        shaped.write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
        return {"written": True}

    commits = run_batches(stream, write, out, "update", "written boolean")
    found = committed(spark, out, "data")
    rest = [c for c in found.columns if c not in (*keys, "epoch")]
    if unique and commits.count() == 1:
        return found.select(*keys, *rest)
    latest = found.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("epoch")).alias("__row"))
    return latest.select(*keys, "__row.*")


def stream_append_source(stream: DataFrame, ts: str, tag: str, address: str, value: Sequence[str]) -> DataFrame:
    """Polled tag values as rows (type, address, JSON value, time)."""
    return stream.select(
        F.col(tag).cast("string").alias("type"), F.col(address).cast("string").alias("address"),
        F.to_json(F.struct(*value)).alias("value"), F.col(ts).cast("timestamp_ntz").alias("ts"),
    )


def _stats(metrics: Sequence[str]) -> list[Column]:
    return [
        f(m).alias(f"{m}_{n}") for m in metrics for n, f in (("max", F.max), ("min", F.min), ("avg", F.avg))
    ] + [F.count(F.lit(1)).alias("n")]


def stream_tumbling_stats(
    stream: DataFrame, entity, ts: str, metrics: Sequence[str], width: str, watermark: str = "1 hour"
) -> DataFrame:
    grouped = stream.withWatermark(ts, watermark).groupBy(F.window(ts, width), *names(entity)).agg(*_stats(metrics))
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("bucket_ts"), *names(entity), *grouped.columns[1 + len(names(entity)) :]
    )


def stream_sliding_stats(
    stream: DataFrame, entity, ts: str, metrics: Sequence[str], width: str = "1 hour", slide: str = "10 minutes",
    watermark: str = "1 hour",
) -> DataFrame:
    grouped = stream.withWatermark(ts, watermark).groupBy(F.window(ts, width, slide), *names(entity)).agg(*_stats(metrics))
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("bucket_ts"), *names(entity), *grouped.columns[1 + len(names(entity)) :]
    )


def gap_text(gap: str) -> str:
    """Session gap one microsecond short of `gap`, so that a distance of exactly `gap` splits."""
    micros = width_us(gap) - 1
    return f"{micros // 1_000_000} seconds {micros % 1_000_000} microseconds"


def stream_session_segments(stream: DataFrame, entity, ts: str, gap: str, watermark: str = "1 hour") -> DataFrame:
    """First and last reading and row count of each stretch without a pause of `gap`."""
    session = F.session_window(ts, gap_text(gap))
    grouped = stream.withWatermark(ts, watermark).groupBy(session.alias("session"), *names(entity))
    found = grouped.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return found.select(
        *names(entity), F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), "n",
    )


def stream_dedup(stream: DataFrame, keys, ts: str, watermark: str = "1 hour") -> DataFrame:
    """Drop rows read again within the watermark."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(names(keys))


def _bucket(ts: str, width: str) -> Column:
    """Start of the window of a time; null for rows without, which `window` would drop."""
    micros = F.unix_micros(F.col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width_us(width))))


def stream_late_data(
    stream: DataFrame, entity, ts: str, metric: str, width: str, margin: str, label: str, place: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(windows, late): statistics of tumbling windows, and the rows that came too late for theirs.

    A window is closed once its end is `margin` or more behind the latest time of the batches before. Rows of closed
    windows, and rows without time, go to `late`, with their `bucket_ts`, for `rerun_windows`; all others are aggregated.
    A batch adds partial statistics, so that the only state is the latest time, in the commit record of each batch.
    place: as in `run_append`; a run that goes on with it knows the windows that earlier runs closed.
    """
    spark = stream.sparkSession
    out = place or shared_path(spark, label)
    keys = names(entity)

    def write(batch: DataFrame, epoch: int, out: str) -> dict[str, object]:
        # Epochs follow each other without gaps, and a record has the latest time of all batches so far.
        before = commit_record(spark, out, epoch - 1) if epoch else None
        latest = before.latest if before else None
        end = F.col("bucket_ts") + F.expr(f"interval {width}")
        closed = F.lit(False) if latest is None else end + F.expr(f"interval {margin}") <= F.lit(latest)
        marked = batch.withColumn("bucket_ts", _bucket(ts, width)).withColumn("__late", F.col(ts).isNull() | closed)
        marked.filter("__late").drop("__late").write.mode("overwrite").parquet(f"{out}/late/epoch={epoch}")
        stats = [F.count(F.lit(1)).alias("n"), F.sum(metric).alias("total"), F.min(metric).alias("least"), F.max(metric).alias("most"), F.max(ts).alias("latest")]
        parts = marked.filter("NOT __late").groupBy("bucket_ts", *keys).agg(*stats)
        parts.write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
        own = spark.read.parquet(f"{out}/data/epoch={epoch}").agg(F.max("latest")).first()[0]
        return {"latest": max((t for t in (latest, own) if t is not None), default=None)}

    run_batches(stream, write, out, "append", "latest timestamp")
    parts, late = committed(spark, out, "data"), committed(spark, out, "late").drop("epoch")
    merged = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")]
    return parts.groupBy("bucket_ts", *keys).agg(*merged), late


def rerun_windows(windows: DataFrame, late: DataFrame, table: DataFrame, entity, ts: str, metric: str, width: str) -> DataFrame:
    """`windows` of `stream_late_data` with those of the `late` rows worked out again from the batch `table`.

    The table is cut to the time range of these windows first, which its scan can use, and then to the windows themselves.
    """
    keys = names(entity)
    touched = late.filter(F.col("bucket_ts").isNotNull()).select("bucket_ts", *keys).distinct()
    span = touched.agg(F.min("bucket_ts").alias("lo"), (F.max("bucket_ts") + F.expr(f"interval {width}")).alias("hi")).first()
    if span.lo is None:
        return windows
    rows = table.filter((F.col(ts) >= F.lit(span.lo)) & (F.col(ts) < F.lit(span.hi))).withColumn("bucket_ts", _bucket(ts, width))
    both = ["bucket_ts", *keys]
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in both]
    rows = rows.join(touched, same(rows, touched), "left_semi")
    stats = [F.count(F.lit(1)).alias("n"), F.sum(metric).alias("total"), F.min(metric).alias("least"), F.max(metric).alias("most")]
    return windows.join(touched, same(windows, touched), "left_anti").unionByName(rows.groupBy(*both).agg(*stats))


def stream_latest_state(stream: DataFrame, entity, ts: str, cols: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest reading per entity; one struct of state per key."""
    latest = F.max_by(F.struct(ts, *cols), F.struct(ts, *tiebreak)).alias("__l")
    return stream.groupBy(*names(entity)).agg(latest).select(*names(entity), "__l.*")


def stream_alerts(stream: DataFrame, subs: DataFrame, label: str, place: str | None = None) -> DataFrame:
    """Notifications of an alert stream: each batch is matched with the subscriptions and cut to one per recipient.

    An alert that comes again in a later batch is routed anew. place: as in `run_append`.
    """

    def notify(batch: DataFrame) -> DataFrame:
        best = al.alert_best_per_recipient(al.alert_candidates(batch, subs, best_only=["subscriber", "notify_id"]))
        return best.select("alert_id", "subscriber", "notify_id", "subscription_id")

    return run_updates(stream, ["alert_id", "subscriber", "notify_id"], label, notify, place, unique=True)


RANGES_KEPT = 6
#: Readings of a key before its limits count.
LEAST_READINGS = 14
SPC_EVENTS = ("increasing", "decreasing", "above", "below")
SPC_STATE = "last double, ranges array<double>, n long, total double, moves long, moved double"


def stream_spc(stream: DataFrame, key: str, ts: str, value: str, tiebreak: str, watermark: str = "1 hour", idle: str = "30 days") -> DataFrame:
    """Readings that break a rule of the individuals chart, in the order of time.

    `event` is increasing or decreasing where the last six signed moving ranges rise or fall without a break, and above or
    below where the reading lies outside the limits on the fly: three sigmas, by the mean moving range, around the mean
    of the key's readings before it, of which there must be LEAST_READINGS. `center`, `lower` and `upper` are these limits.
    State per key: the last reading, six ranges and the sums of the chart. Readings without value are left out.
    """
    width = spc_coefficients(2).d2

    def step(k: tuple, held: tuple | None, rows: Columns) -> tuple[tuple, Columns | None]:
        last, ranges, n, total, moves, moved = held or (None, [], 0, 0.0, 0, 0.0)
        x = np.asarray(rows[value], float)
        change = np.diff(x, prepend=np.nan if last is None else last)
        known = np.concatenate([np.array(ranges, float), change[np.isfinite(change)]])
        rises = np.sign(np.diff(known))
        size = RANGES_KEPT - 1
        runs = np.convolve(rises, np.ones(size), "valid") if len(rises) >= size else np.zeros(0)
        trend = np.zeros(len(x))
        ends = min(len(runs), len(x))  # a run ends at a reading of these rows, or the rows before have told of it
        trend[len(x) - ends :] = runs[len(runs) - ends :]
        # Sums before each reading, added one after the other, so that they don't depend on the batches.
        sums, moving = np.cumsum([total, *x]), np.cumsum([moved, *np.abs(np.nan_to_num(change))])
        counts, steps = n + np.arange(len(x) + 1), moves + np.concatenate([[0], np.cumsum(np.isfinite(change))])
        with np.errstate(invalid="ignore", divide="ignore"):
            center = sums[:-1] / counts[:-1]
            spread = SIGMAS / width * moving[:-1] / steps[:-1]
        told = counts[:-1] >= LEAST_READINGS
        hits = np.stack([trend == size, trend == -size, told & (x > center + spread), told & (x < center - spread)])
        kind, at = np.nonzero(hits)
        limits = {n: np.where(told, v, np.nan)[at] for n, v in (("center", center), ("lower", center - spread), ("upper", center + spread))}
        kept = (float(x[-1]), known[-RANGES_KEPT:].tolist(), int(counts[-1]), float(sums[-1]), int(steps[-1]), float(moving[-1]))
        if not len(at):
            return kept, None
        return kept, {key: np.full(len(at), k[0], object), tiebreak: rows[tiebreak][at], "event": np.array(SPC_EVENTS, object)[kind], **limits}

    columns = stream.select(key, ts, tiebreak, F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull())
    output = f"{key} {_ddl(stream, key)}, {tiebreak} {_ddl(stream, tiebreak)}, event string, center double, lower double, upper double"
    return in_time_order(columns, [key], ts, [tiebreak], [value], step, SPC_STATE, output, watermark, idle)


TRANSITIONS = ("door_opened", "run_start", "run_stop")


def stream_cycle_detect(
    stream: DataFrame, key: str, ts: str, door: str, mixer: str, tiebreak: str, watermark: str = "1 hour", idle: str = "30 days"
) -> DataFrame:
    """Transitions (door_opened, run_start, run_stop) of each machine in the order of time, with the start of the cycle before it.

    A cycle starts when the door is opened; `cycle_start` is the last such time before the transition, null in the first cycle.
    State per key: last door, last mixer state and the start of the cycle.
    """

    def step(k: tuple, held: tuple | None, rows: Columns) -> tuple[tuple, pd.DataFrame | None]:
        held_door, held_mixer, held_start = held or (None, None, None)

        def before(values: np.ndarray, valid: np.ndarray, known: object) -> tuple[np.ndarray, object]:
            """The last valid value before each row, and after all of them."""
            at = np.maximum.accumulate(np.where(valid, np.arange(1, len(values) + 1), 0))
            filled = np.concatenate([np.array([known], object), values])[np.concatenate([[0], at])]
            return filled[:-1], filled[-1]

        # Plain arrays: a key has few rows at a time, and a pandas operation costs more than its rows.
        doors, mixers = np.asarray(rows[door], object), np.asarray(rows[mixer], object)
        opens, runs, stops = doors == "open", mixers == "RUN", mixers == "STOP"
        old_door, held_door = before(doors, opens | (doors == "close"), held_door)
        old_mixer, held_mixer = before(mixers, runs | stops, held_mixer)
        opened = opens & (old_door == "close")
        old_start, held_start = before(np.asarray(rows["event_us"]).astype(object), opened, held_start)
        started = runs & ((old_mixer == None) | (old_mixer == "STOP"))  # noqa: E711
        stopped = stops & (old_mixer == "RUN")
        kind, at = np.nonzero(np.stack([opened, started, stopped]))
        held = (held_door, held_mixer, held_start)
        if not len(at):
            return held, None
        cycles = pd.array(old_start[at], dtype="Int64")
        return held, pd.DataFrame({key: k[0], tiebreak: np.asarray(rows[tiebreak])[at], "transition": np.array(TRANSITIONS, object)[kind], "cycle_us": cycles})

    columns = stream.select(key, ts, tiebreak, door, mixer)
    output = f"{key} {_ddl(stream, key)}, {tiebreak} {_ddl(stream, tiebreak)}, transition string, cycle_us long"
    found = in_time_order(columns, [key], ts, [tiebreak], [door, mixer], step, "door string, mixer string, start_us long", output, watermark, idle)
    return found.select(key, tiebreak, "transition", F.timestamp_micros("cycle_us").cast("timestamp_ntz").alias("cycle_start"))


def _ddl(stream: DataFrame, column: str) -> str:
    return stream.schema[column].dataType.simpleString()


def running_flag(latest: DataFrame, devices: DataFrame, key: str, ts: str, bit: str, as_of: Column, age: str) -> DataFrame:
    """'1' or '0' per device from its latest status, '0' when that is older than `age` or absent."""
    fresh = F.col(ts) >= as_of - F.expr(f"interval {age}")
    joined = devices.select(key).join(latest, key, "left")
    return joined.select(key, F.when(fresh, F.col(bit)).otherwise("0").alias("running"))
