"""Data tests as DataFrames of failing rows (empty means passed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstream.functions.timekeys import as_ntz, interval
from millstream.functions.wallclock import wall_us, width_us
from millstream.operators import chunked
from millstream.operators.chunked import CHUNK


def dq_not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNull())


def dq_unique(df: DataFrame, c: str) -> DataFrame:
    return dq_unique_combination(df.filter(F.col(c).isNotNull()), [c])


def dq_unique_combination(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    df = df if where is None else df.filter(where)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def dq_accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; null is not tested."""
    counted = df.groupBy(F.col(c).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def dq_not_accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    counted = df.groupBy(F.col(c).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("value_field").isin(list(values)))


def dq_accepted_range(df: DataFrame, c: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((F.col(c) < low) if inclusive else (F.col(c) <= low))
    if high is not None:
        bad = bad | ((F.col(c) > high) if inclusive else (F.col(c) >= high))
    return df.filter(bad)


def _counts(df: DataFrame, group_by: Sequence[str], out: str, measure: Column | None = None) -> DataFrame:
    return df.groupBy(*group_by).agg((F.count(F.lit(1)) if measure is None else measure).alias(out))


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of both relations per group, 0 where a group is missing: one shuffle over the stacked rows."""
    left = a.select(*group_by, F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    right = b.select(*group_by, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    return left.unionByName(right).groupBy(*group_by).agg(
        F.coalesce(F.sum("__a"), F.lit(0)).alias("count_a"), F.coalesce(F.sum("__b"), F.lit(0)).alias("count_b")
    )


def dq_equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    return _paired_counts(a, b, group_by).filter("count_a <> count_b")


def dq_fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups in which `a` does not have fewer rows than `b`."""
    return _paired_counts(a, b, group_by).filter("count_a >= count_b")


def dq_cardinality_equality(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Values whose number of rows differs between two columns."""
    left, right = a.select(F.col(a_col).alias("value_field")), b.select(F.col(b_col).alias("value_field"))
    return _paired_counts(left, right, ["value_field"]).filter("count_a <> count_b")


def dq_expression_is_true(df: DataFrame, expression: Column, where: Column | None = None) -> DataFrame:
    """Rows for which the expression is not true; null counts as failing."""
    df = df if where is None else df.filter(where)
    return df.filter(~F.coalesce(expression, F.lit(False)))


def dq_recency(df: DataFrame, ts: str, age: str, as_of, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose latest time is older than `as_of - age`."""
    latest = df.groupBy(*group_by).agg(F.max(ts).alias("most_recent"))
    threshold = as_ntz(as_of) - interval(age)
    return latest.filter(F.col("most_recent").isNull() | (F.col("most_recent") < threshold))


def dq_at_least_one(df: DataFrame, c: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any value in the column."""
    return _counts(df, group_by, "filled", F.count(c)).filter("filled = 0")


def dq_not_constant(df: DataFrame, c: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups in which the column has exactly one value. Minimum and maximum decide it without a distinct."""
    spread = df.groupBy(*group_by).agg(F.min(c).alias("low"), F.max(c).alias("high"))
    return spread.filter(F.col("low") == F.col("high"))


def dq_not_empty_string(df: DataFrame, c: str, trim: bool = True) -> DataFrame:
    text = F.trim(c) if trim else F.col(c)
    return df.filter(text == "")


def dq_not_null_proportion(
    df: DataFrame, c: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = (F.count(c) / F.count(F.lit(1))).alias("not_null_proportion")
    found = df.groupBy(*group_by).agg(share)
    return found.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def dq_relationships_where(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, child_where: Column | None = None,
    parent_where: Column | None = None,
) -> DataFrame:
    """Child keys without a parent, with conditions on both sides."""
    child = child if child_where is None else child.filter(child_where)
    parent = parent if parent_where is None else parent.filter(parent_where)
    known = parent.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def dq_mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: Sequence[str] = (), gaps: str = "allowed",
    zero_length: bool = False, chunk: Column | None = None,
) -> DataFrame:
    """Ranges that break the rules against the next range of their partition.

    gaps: 'allowed' (upper <= next lower), 'not_allowed' (equal), 'required' (strictly below). The last range of
    a partition may be open. Without `zero_length` the lower bound must be below the upper one.
    """
    keys = list(partition_by)
    chunk = chunk if chunk is not None else F.year(lower).cast("long")
    rows = df.select(*keys, lower, upper).withColumn(CHUNK, chunk)
    rows = chunked.following(rows, keys, [lower, upper], [lower], "__next")
    after = F.col("__next").getField(lower)
    ordered = (F.col(lower) <= F.col(upper)) if zero_length else (F.col(lower) < F.col(upper))
    meets = {"allowed": F.col(upper) <= after, "not_allowed": F.col(upper) == after, "required": F.col(upper) < after}
    last = F.col("__next").isNull()
    lower_ok = F.coalesce(ordered, last & F.col(upper).isNull(), F.lit(False))
    next_ok = F.when(last, F.lit(True)).otherwise(F.coalesce(meets[gaps], F.lit(False)))
    return rows.withColumn("next_lower", after).filter(~(lower_ok & next_ok)).drop("__next", CHUNK)


def dq_sequential_values(
    df: DataFrame, c: str, step, group_by: Sequence[str] = (), chunk: Column | None = None
) -> DataFrame:
    """Values that do not follow their predecessor by `step`: a number, or an interval text for times."""
    keys = list(group_by)
    if chunk is None:
        chunk = F.floor(F.col(c) / 100_000).cast("long") if not isinstance(step, str) else F.year(c).cast("long")
    rows = df.select(*keys, c).withColumn(CHUNK, chunk)
    rows = chunked.previous(rows, keys, [c], [c], "__prev").withColumn("previous_value", F.col("__prev").getField(c))
    if isinstance(step, str):
        follows = wall_us(c) - wall_us("previous_value") == F.lit(width_us(step))
    else:
        follows = F.col(c) == F.col("previous_value") + step
    return rows.filter(F.col("__prev").isNotNull() & ~F.coalesce(follows, F.lit(False))).drop("__prev", CHUNK)


def date_spine(bounds: DataFrame, start: str, end: str, step: str = "1 day", out: str = "date_day") -> DataFrame:
    """Half-open spine [start, end) for every row of `bounds` (its other columns are kept)."""
    points = F.sequence(start, end, interval(step))
    rest = [c for c in bounds.columns if c not in (start, end)]
    rows = bounds.select(*rest, F.col(end).alias("__end"), F.explode(points).alias(out))
    return rows.filter(F.col(out) < F.col("__end")).drop("__end")


def generate_series(bounds: DataFrame, upper: str, out: str = "generated_number") -> DataFrame:
    """Numbers 1 .. `upper` for every row of `bounds`."""
    rest = [c for c in bounds.columns if c != upper]
    return bounds.filter(F.col(upper) >= 1).select(*rest, F.explode(F.sequence(F.lit(1), F.col(upper))).alias(out))


def load_count_validation(df: DataFrame, id_col: str, where: Column | None = None) -> DataFrame:
    """Rows and distinct ids of a loaded slice."""
    df = df if where is None else df.filter(where)
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(id_col).alias("id_count"))
