"""Ordered per-key computations cut into chunks, so that a hot key is never one task.

`Window.partitionBy(key).orderBy(ts)` sorts all rows of a key in one task. When one sensor holds
a third of the data this is the whole job. Here each key's series is cut into chunks by a
monotone function of the order (an hour of time, a range of row numbers):

1. windows run inside (key, chunk);
2. one summary row per (key, chunk) is scanned in chunk order (rows = number of chunks);
3. the carried value is joined back on (key, chunk).

The shuffle key is always (key, chunk). Summaries are built with map-side partial aggregation.

Where keys are many and have few rows each, nearly every row is a chunk of its own, and summaries cost more than the rows.
Operators that are told so (`whole`, from `fits_whole`) run one window over the key instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.functions.wallclock import bucket_no

CHUNK = "__chunk"
DEFAULT_WIDTH = "1 hour"
BLOCK_ROWS = 4096
#: Rows of a key up to which one window over the whole key is cheaper than chunks, and small enough for a task.
WHOLE_ROWS = 50_000


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def with_time_chunk(df: DataFrame, ts: str, width: str = DEFAULT_WIDTH) -> DataFrame:
    return df.withColumn(CHUNK, bucket_no(ts, width))


def fits_whole(df: DataFrame, keys: str | Sequence[str]) -> bool:
    """Whether no key, nor the rows with null keys, has more than WHOLE_ROWS rows. Counts them in a job."""
    most = df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (most or 0) <= WHOLE_ROWS


def order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def key_helpers(keys: Sequence[str]) -> list[str]:
    """Columns that stand for the keys inside a scan: value without nulls, and whether it was null."""
    return [f"__{part}{i}" for i in range(len(keys)) for part in ("k", "n")]


def _filler(kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    return F.lit("" if isinstance(kind, T.StringType) else "1970-01-01").cast(kind)


def helper_columns(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """The columns of `key_helpers`."""
    filled = [F.coalesce(F.col(k), _filler(df.schema[k].dataType)) for k in keys]
    return dict(zip(key_helpers(keys), [c for k, value in zip(keys, filled) for c in (value, F.col(k).isNull())]))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the key helpers and make the chunk non-null.

    Null keys form a group of their own. A null-safe join would compare other expressions than the window is
    partitioned by, and the rows would be shuffled twice; on these columns join and window share one shuffle.
    """
    if key_helpers(keys)[:1] and key_helpers(keys)[0] in df.columns:
        return df
    chunk = F.coalesce(CHUNK, F.lit(-(1 << 60)).cast(df.schema[CHUNK].dataType))
    return df.withColumns({CHUNK: chunk} | helper_columns(df, keys))


def local_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Rows of one (key, chunk) in order, on the key helpers."""
    return Window.partitionBy(*key_helpers(keys), CHUNK).orderBy(*order)


def bare(df: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Drop the key helpers and other scratch columns."""
    return df.drop(*key_helpers(keys), *more)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys meet; the right copies of the keys are dropped."""
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in on],
        *[c for c in right.columns if c not in on],
    )
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in on])
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def carry(
    df: DataFrame,
    keys: Sequence[str],
    parts: dict[str, Column],
    scan: Callable[[WindowSpec], dict[str, Column]],
    then: Callable[[WindowSpec], dict[str, Column]] | None = None,
) -> DataFrame:
    """Aggregate `parts` per (key, chunk), scan them in chunk order, join the result to every row.

    `then` is a second scan that may use the columns of the first. `df` is evaluated twice, so operators put all
    they need into one call. The key helpers stay on the result for `local_window`; `bare` drops them.
    """
    df = with_keys(df, keys)
    helpers = key_helpers(keys)
    by = [*helpers, CHUNK]
    summary = df.groupBy(*by).agg(*[c.alias(n) for n, c in parts.items()])
    w = Window.partitionBy(*helpers).orderBy(CHUNK)
    outs = scan(w)
    summary = summary.withColumns(outs)
    if then is not None:
        more = then(w)
        summary = summary.withColumns(more)
        outs = outs | more
    carried = summary.select(*[F.col(c).alias(f"__r{c}") for c in by], *outs)
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__r{c}") for c in by])
    # The rows are shuffled for the window anyway. A broadcast summary would save nothing, and may have nearly as many rows.
    return df.join(carried.hint("merge"), same, "inner").drop(*[f"__r{c}" for c in by])


def previous(df: DataFrame, keys, order, cols, out: str) -> DataFrame:
    """`out` = struct of `cols` of the preceding row of the key, null for its first row."""
    keys, order, cols = names(keys), names(order), names(cols)
    value = F.struct(*cols)
    df = carry(
        df,
        keys,
        {"__last": F.max_by(value, order_struct(order))},
        lambda w: {"__before": F.lag("__last").over(w)},
    )
    near = F.lag(value).over(local_window(keys, order))
    return bare(df.withColumn(out, F.coalesce(near, F.col("__before"))), keys, "__before")


def following(df: DataFrame, keys, order, cols, out: str, whole: bool = False) -> DataFrame:
    """`out` = struct of `cols` of the next row of the key, null for its last row."""
    keys, order, cols = names(keys), names(order), names(cols)
    value = F.struct(*cols)
    if whole:
        return df.withColumn(out, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))
    df = carry(
        df,
        keys,
        {"__first": F.min_by(value, order_struct(order))},
        lambda w: {"__after": F.lead("__first").over(w)},
    )
    near = F.lead(value).over(local_window(keys, order))
    return bare(df.withColumn(out, F.coalesce(near, F.col("__after"))), keys, "__after")


def fill(
    df: DataFrame, keys, order, cols, backward: bool = False, suffix: str = "", strict: bool = False, whole: bool = False
) -> DataFrame:
    """Last valid value up to each row (or next valid value from it on) for every column in `cols`.

    `strict` leaves the row itself out.
    """
    keys, order, cols = names(keys), names(order), names(cols)
    pick = F.min_by if backward else F.max_by
    parts = {
        f"__v{i}": pick(F.col(c), F.when(F.col(c).isNotNull(), order_struct(order))) for i, c in enumerate(cols)
    }

    def scan(w: WindowSpec) -> dict[str, Column]:
        if backward:
            frame = w.rowsBetween(1, Window.unboundedFollowing)
            return {f"__c{i}": F.first(f"__v{i}", ignorenulls=True).over(frame) for i in range(len(cols))}
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        return {f"__c{i}": F.last(f"__v{i}", ignorenulls=True).over(frame) for i in range(len(cols))}

    if whole:
        w = Window.partitionBy(*keys).orderBy(*order)
    else:
        df, w = carry(df, keys, parts, scan), local_window(keys, order)
    if backward:
        frame = w.rowsBetween(1 if strict else 0, Window.unboundedFollowing)
        near = {c: F.first(c, ignorenulls=True).over(frame) for c in cols}
    else:
        frame = w.rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        near = {c: F.last(c, ignorenulls=True).over(frame) for c in cols}
    if whole:
        return df.withColumns({f"{c}{suffix}": near[c] for c in cols})
    filled = {f"{c}{suffix}": F.coalesce(near[c], F.col(f"__c{i}")) for i, c in enumerate(cols)}
    return bare(df.withColumns(filled), keys, *[f"__c{i}" for i in range(len(cols))])


def running_sum(df: DataFrame, keys, order, sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per key."""
    keys, order = names(keys), names(order)
    outs = list(sums)
    df = carry(
        df,
        keys,
        {f"__s{i}": F.sum(sums[o]) for i, o in enumerate(outs)},
        lambda w: {
            f"__c{i}": F.sum(f"__s{i}").over(w.rowsBetween(Window.unboundedPreceding, -1)) for i in range(len(outs))
        },
    )
    frame = local_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    total = {
        o: F.coalesce(F.sum(sums[o]).over(frame), F.lit(0)) + F.coalesce(F.col(f"__c{i}"), F.lit(0))
        for i, o in enumerate(outs)
    }
    return bare(df.withColumns(total), keys, *[f"__c{i}" for i in range(len(outs))])


def running_max(df: DataFrame, keys, order, c: str, out: str) -> DataFrame:
    """Maximum of `c` over all strictly earlier rows of the key."""
    keys, order = names(keys), names(order)
    before = Window.unboundedPreceding
    df = carry(
        df,
        keys,
        {"__m": F.max(c)},
        lambda w: {"__c": F.max("__m").over(w.rowsBetween(before, -1))},
    )
    near = F.max(c).over(local_window(keys, order).rowsBetween(before, -1))
    return bare(df.withColumn(out, F.greatest(near, F.col("__c"))), keys, "__c")


def numbered(df: DataFrame, keys, order, out: str = "rn", total: str | None = None) -> DataFrame:
    """Row number per key from 1 on, and optionally the number of rows of the key."""
    keys, order = names(keys), names(order)

    def scan(w: WindowSpec) -> dict[str, Column]:
        found = {"__c": F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1))}
        if total:
            found[total] = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return found

    df = carry(df, keys, {"__n": F.count(F.lit(1))}, scan)
    near = F.row_number().over(local_window(keys, order)).cast("long")
    return bare(df.withColumn(out, near + F.coalesce(F.col("__c"), F.lit(0))), keys, "__c")


def with_totals(df: DataFrame, keys, parts: dict[str, Column], whole: dict[str, str]) -> DataFrame:
    """Attach whole-key totals to every row.

    `parts` are aggregates per (key, chunk); `whole` says how chunks combine: sum, min or max.
    """
    keys = names(keys)
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    span = (Window.unboundedPreceding, Window.unboundedFollowing)
    totals = carry(df, keys, parts, lambda w: {n: combine[how](n).over(w.rowsBetween(*span)) for n, how in whole.items()})
    return bare(totals, keys)


def in_blocks(df: DataFrame, rn: str, before: int = 0, after: int = 0, rows: int = BLOCK_ROWS) -> DataFrame:
    """Cut a numbered series into blocks of `rows` and copy the edge rows a moving frame needs.

    Adds `__chunk` (block) and `__own` (false for copies). A frame of `before` preceding and `after`
    following rows is then complete inside (key, block); drop rows with `__own` false afterwards.
    """
    block = F.floor((F.col(rn) - 1) / rows).cast("long")
    at = (F.col(rn) - 1) % rows
    copies = [block]
    if before:
        copies.append(F.when(at >= rows - before, block + 1))
    if after:
        copies.append(F.when((at < after) & (block > 0), block - 1))
    df = df.withColumn("__home", block).withColumn(CHUNK, F.explode(F.array_compact(F.array(*copies))))
    return df.withColumn("__own", F.col(CHUNK) == F.col("__home")).drop("__home")
