"""Exact quantiles of unbounded groups without collecting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millstream.operators.chunked import join_null_safe, names

ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys, c: str, probs: Sequence[float], outs: Sequence[str]) -> DataFrame:
    """Linearly interpolated quantiles per key: one row (keys, *outs, n).

    A mergeable sketch brackets each quantile; the rows below the bracket are only counted, and the few rows
    inside it (about 8 / ACCURACY of the group) are ranked exactly. The aggregate `percentile` would hold all
    distinct values of a hot key in one task.
    """
    keys = names(keys)
    df = df.select(*keys, F.col(c).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    slack = 4.0 / ACCURACY
    lows = [max(0.0, p - slack) for p in probs]
    highs = [min(1.0, p + slack) for p in probs]
    sketch = df.groupBy(*keys).agg(
        F.percentile_approx("__v", [*lows, *highs], ACCURACY).alias("__q"),
        F.count(F.lit(1)).alias("n"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
    )
    k = len(probs)
    brackets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.when(F.lit(lows[i] <= 0.0), F.col("__min")).otherwise(F.col("__q")[i]).alias("lo"),
                F.when(F.lit(highs[i] >= 1.0), F.col("__max")).otherwise(F.col("__q")[k + i]).alias("hi"),
                (F.lit(float(p)) * (F.col("n") - 1)).alias("h"),
            )
            for i, p in enumerate(probs)
        ]
    )
    # One neighbour on each side is needed for interpolation; the bracket slack covers it except in tiny groups,
    # where the sketch is exact and the bracket is widened to the ends.
    tiny = F.col("n") <= ACCURACY
    brackets = F.transform(
        brackets,
        lambda b: F.struct(
            b["i"].alias("i"),
            F.when(tiny, F.col("__min")).otherwise(b["lo"]).alias("lo"),
            F.when(tiny, F.col("__max")).otherwise(b["hi"]).alias("hi"),
            b["h"].alias("h"),
        ),
    )
    plan = sketch.select(*keys, "n", brackets.alias("__b"))
    if keys:
        tagged = join_null_safe(df, plan, keys)
    else:
        tagged = df.crossJoin(F.broadcast(plan))  # one row by construction
    tagged = tagged.select(*keys, "n", "__v", F.explode("__b").alias("__b")).select(*keys, "n", "__v", "__b.*")
    # Counting equal values first keeps a heavily repeated value one row.
    below = F.col("__v") < F.col("lo")
    inside = (F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi"))
    counted = (
        tagged.filter(below | inside)
        .groupBy(*keys, "i", "n", "h", F.when(inside, F.col("__v")).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    w = Window.partitionBy(*keys, "i").orderBy(F.col("__v").asc_nulls_first())
    upto = F.sum("__times").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("__upto", upto)
    lower, upper = F.floor("h"), F.ceil("h")
    first_rank = F.col("__upto") - F.col("__times")

    def value_at(rank):
        return F.max(F.when((first_rank <= rank) & (rank < F.col("__upto")), F.col("__v")))

    picked = ranked.groupBy(*keys, "i", "n", "h").agg(value_at(lower).alias("__a"), value_at(upper).alias("__z"))
    exact = F.col("__a") + (F.col("__z") - F.col("__a")) * (F.col("h") - F.floor("h"))
    picked = picked.select(*keys, "n", "i", exact.alias("__x"))
    values = [F.max(F.when(F.col("i") == i, F.col("__x"))).alias(o) for i, o in enumerate(outs)]
    return picked.groupBy(*keys, "n").agg(*values).select(*keys, *outs, "n")


def small_medians(df: DataFrame, keys, c: str, out: str) -> DataFrame:
    """(keys, out): the medians of `exact_quantiles` for keys of few rows (see `chunked.fits_whole`), from a sorted list each."""
    keys = names(keys)
    lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.col(c).cast("double"))).alias("__all"))
    lists = lists.filter(F.size("__all") > 0).withColumn("__h", F.lit(0.5) * (F.size("__all") - 1))
    low, high = (F.get("__all", f("__h").cast("int")) for f in (F.floor, F.ceil))
    return lists.select(*keys, (low + (high - low) * (F.col("__h") - F.floor("__h"))).alias(out))


def percentile_iqr(df: DataFrame, keys, c: str, k: float = 1.5) -> DataFrame:
    """Quartiles, interquartile range and fences per key."""
    quartiles = exact_quantiles(df, keys, c, [0.25, 0.75], ["q1", "q3"]).drop("n")
    iqr = F.col("q3") - F.col("q1")
    return quartiles.withColumns(
        {"iqr": iqr, "lower_fence": F.col("q1") - k * iqr, "upper_fence": F.col("q3") + k * iqr}
    )


def basic_stats(df: DataFrame, keys, c: str) -> DataFrame:
    """Mean, geometric mean (positive values only), median, population variance and deviation per key."""
    keys = names(keys)
    positive = F.when(F.min(c) > 0, F.exp(F.avg(F.when(F.col(c) > 0, F.ln(c)))))
    moments = df.groupBy(*keys).agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        positive.alias("geo_mean"),
        F.var_pop(c).alias("variance"),
        F.stddev_pop(c).alias("stddev"),
    )
    medians = exact_quantiles(df, keys, c, [0.5], ["median"]).drop("n")
    return join_null_safe(moments, medians, keys, "left")


def describe_stats(df: DataFrame, c: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column, as one row."""
    moments = df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )
    quartiles = exact_quantiles(df, [], c, [0.25, 0.5, 0.75], ["p25", "p50", "p75"]).drop("n")
    return moments.crossJoin(F.broadcast(quartiles))  # both sides are one row

