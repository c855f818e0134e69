"""Progress markers and the ranges to process next. A marker moves only after success."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstream.functions.timekeys import as_ntz, interval
from millstream.functions.wallclock import bucket_start


def incremental_range(
    progress: DataFrame, job: str, marker: str, as_of, step: str = "1 day", margin: str = "0 seconds",
    max_span: str | None = None, align: str | None = None,
) -> DataFrame:
    """Next [range_start, range_end) per job; jobs with nothing to do drop out.

    Starts at the marker, ends one `step` later (or at `max_span`), never after `as_of - margin`. `align` is a bucket
    width such as '10 minutes', or a time of day 'HH:mm' to which all bounds are moved.
    """

    def aligned(ts: Column) -> Column:
        if align is None:
            return ts
        if ":" in align:
            hours, minutes = align.split(":")
            return ts.cast("date").cast("timestamp_ntz") + interval(f"{int(hours)} hours {int(minutes)} minutes")
        return bucket_start(ts, align)

    limit = aligned(as_ntz(as_of) - interval(margin))
    start = aligned(F.col(marker))
    wanted = aligned(F.col(marker) + interval(max_span or step))
    ranges = progress.select(F.col(job), start.alias("range_start"), F.least(wanted, limit).alias("range_end"))
    return ranges.filter(F.col("range_start") < F.col("range_end"))


def backfill_windows(bounds: DataFrame, start: str, end: str, step: str = "1 hour") -> DataFrame:
    """Chunks (chunk_start, chunk_end) of every row of `bounds`: ends are inclusive, the next chunk starts one second
    later, the last is cut at `end`."""
    rest = [c for c in bounds.columns if c not in (start, end)]
    rows = bounds.select(*rest, F.col(end).alias("__end"), F.explode(F.sequence(start, end, interval(step))).alias("chunk_start"))
    whole = F.col("chunk_start") + interval(step) - interval("1 second")
    return rows.withColumn("chunk_end", F.least(whole, F.col("__end"))).drop("__end")


def delta_history_advance(
    history: DataFrame, job: str, start: str, end: str, delta: str, as_of, margin: str = "0 seconds"
) -> DataFrame:
    """Next range [old end, old end + delta], cut at `as_of - margin`. Nothing is left to do, and the job drops out,
    when the cut falls at or before the old end; so a new range never overlaps the old one."""
    limit = as_ntz(as_of) - interval(margin)
    moved = history.select(
        F.col(job),
        F.col(start).alias("last_start"),
        F.col(end).alias("next_start"),
        F.least(F.col(end) + interval(delta), limit).alias("next_end"),
    )
    return moved.filter(F.col("next_start") < F.col("next_end"))


def min_marker(progress: DataFrame, job: str, marker: str, jobs: Sequence[str], as_of, offset: str = "1 day") -> DataFrame:
    """Earliest marker over several jobs, at most `as_of - offset`."""
    chosen = progress.filter(F.col(job).isin(list(jobs)))
    return chosen.agg(F.least(F.min(marker), as_ntz(as_of) - interval(offset)).alias("next_run"))


def advance(progress: DataFrame, job: str, marker: str, done: DataFrame) -> DataFrame:
    """Progress after the finished ranges (job, range_end)."""
    ends = done.groupBy(job).agg(F.max("range_end").alias("__end"))
    return progress.join(ends, job, "left").withColumn(marker, F.greatest(F.col(marker), F.col("__end"))).drop("__end")
