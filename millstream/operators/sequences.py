"""Moving windows over numbered series, anomaly scoring and removal."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.operators import chunked
from millstream.operators.chunked import CHUNK, join_null_safe, names
from millstream.operators.quantiles import percentile_iqr
from millstream.session import settle

Scorer = Callable[[Column], Column]


def moving_mean_error(window: Column) -> Column:
    """Mean squared distance of a window from its own mean: the default reconstruction error."""
    n = F.size(window)
    mean = F.aggregate(window, F.lit(0.0), lambda a, x: a + x) / n
    return F.aggregate(window, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n


def batch_scorer(load: Callable[[], Callable[[np.ndarray], np.ndarray]], batch: int = 128) -> Scorer:
    """Scorer from a model: `load()` runs once per Python worker and returns a function that maps a
    (rows, window) matrix to one score per row. Windows arrive in Arrow batches and are scored `batch` at a time.
    """

    @F.pandas_udf("double")
    def score(windows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for series in windows:
            scores = [
                model(np.stack(series.iloc[i : i + batch].to_list())) for i in range(0, len(series), batch)
            ]
            yield pd.Series(np.concatenate(scores) if scores else np.empty(0), dtype="float64")

    return lambda column: score(column)


def _windows(df: DataFrame, keys, ts: str, c: str, size: int, drop_last: bool, tiebreak: Sequence[str]) -> DataFrame:
    """Every row with its row number, the row count and the window starting there (null where none starts)."""
    keys, order = names(keys), [ts, *tiebreak]
    df = chunked.with_time_chunk(df, ts)
    df = chunked.numbered(df, keys, order, "rn", "n").drop(CHUNK)
    blocks = chunked.in_blocks(df, "rn", after=size - 1)
    w = Window.partitionBy(*keys, CHUNK).orderBy("rn").rowsBetween(0, size - 1)
    last = F.col("n") - size + (0 if drop_last else 1)
    values = F.transform(F.collect_list(F.struct(F.col(c).alias("v"))).over(w), lambda x: x["v"])
    return blocks.withColumn("window", F.when(F.col("rn") <= last, values)).filter("__own").drop("__own", CHUNK)


def sliding_sequences(
    df: DataFrame, keys, ts: str, c: str, size: int, drop_last: bool = True, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Windows of `size` rows, stride 1: (keys, rn of the first row, window).

    `drop_last` leaves out the final window, so n rows give n - size windows.
    """
    rows = _windows(df, keys, ts, c, size, drop_last, tiebreak)
    return rows.filter(F.col("window").isNotNull()).select(*names(keys), "rn", "window")


def model_score_windows(windows: DataFrame, scorer: Scorer = moving_mean_error, window: str = "window") -> DataFrame:
    return windows.withColumn("score", scorer(F.col(window)))


def window_anomaly_removal(
    df: DataFrame, keys, ts: str, c: str, size: int, scorer: Scorer = moving_mean_error, k: float = 1.5,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Drop every row covered by a window whose score lies outside the quartile fences of its key.

    Series shorter than a window pass unchanged. Scores are checkpointed, so the model runs once per window although
    the fences and the removal both read them.
    """
    keys = names(keys)
    scored = _windows(df, keys, ts, c, size, True, tiebreak)
    scored = scored.withColumn("__score", F.when(F.col("window").isNotNull(), scorer(F.col("window")))).drop("window")
    scored = settle(scored)
    fences = percentile_iqr(scored.filter(F.col("__score").isNotNull()), keys, "__score", k)
    scored = join_null_safe(scored, fences.select(*keys, "lower_fence", "upper_fence"), keys, "left")
    odd = (F.col("__score") < F.col("lower_fence")) | (F.col("__score") > F.col("upper_fence"))
    scored = scored.withColumn("__odd", F.coalesce(odd, F.lit(False)))
    blocks = chunked.in_blocks(scored, "rn", before=size - 1)
    w = Window.partitionBy(*keys, CHUNK).orderBy("rn").rowsBetween(-(size - 1), 0)
    blocks = blocks.withColumn("__covered", F.max("__odd").over(w))
    return blocks.filter("__own and not __covered").drop(
        "__own", "__covered", "__odd", "__score", "lower_fence", "upper_fence", "rn", "n", CHUNK
    )


def range_filter_min_points(
    df: DataFrame, keys, ts: str, c: str, low: float, high: float, min_points: int
) -> DataFrame:
    """Readings strictly between `low` and `high`, equal times averaged, keys with too few points dropped."""
    keys = names(keys)
    points = df.filter((F.col(c) > low) & (F.col(c) < high)).groupBy(*keys, ts).agg(F.avg(c).alias(c))
    enough = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_points)
    return points.join(enough.select(*keys), keys, "left_semi")


def model_score_cycles(
    df: DataFrame, vector: str, scorer: Scorer, threshold: float = 0.1, is_3_stage: str = "is_3_stage"
) -> DataFrame:
    """Probability per cycle; below `threshold` is an anomaly, and the result also needs a three-stage cycle.

    A missing probability is no anomaly and is reported as 0.5.
    """
    df = df.withColumn("anomaly_prob", scorer(F.col(vector)))
    odd = F.coalesce((F.col("anomaly_prob") < threshold) & ~F.isnan("anomaly_prob"), F.lit(False))
    df = df.withColumn("is_anomaly", odd)
    missing = F.col("anomaly_prob").isNull() | F.isnan("anomaly_prob")
    return df.withColumns(
        {
            "anomaly_prob": F.when(missing, 0.5).otherwise(F.col("anomaly_prob")),
            "result": F.col("is_anomaly") & F.col(is_3_stage),
        }
    )


def udf_python_check(df: DataFrame, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a user's check; its failing rows come back as (failed_rows), 0 meaning passed."""
    return check(df).agg(F.count(F.lit(1)).alias("failed_rows"))


def explode_detail(df: DataFrame, ids, arrays: dict[str, str], item: str = "readings") -> DataFrame:
    """One row per array element with its type label and its number in order, from 1."""
    typed = F.array(*[F.struct(F.lit(label).alias("type"), F.col(c).alias(item)) for label, c in arrays.items()])
    rows = df.select(*names(ids), F.explode(typed).alias("__t"))
    rows = rows.select(*names(ids), F.col("__t.type").alias("temp_type"), F.posexplode(F.array_sort(f"__t.{item}")))
    return rows.select(*names(ids), "temp_type", (F.col("pos") + 1).alias("seq_no"), "col.*")
