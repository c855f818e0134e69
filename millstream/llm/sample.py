"""Bounded samples of each group, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group let through before the exact choice, as a multiple of those wanted.
SPARE = 3
_STEPS = 1 << 40


def smallest(rows: DataFrame, group: str, by: str, n: int) -> DataFrame:
    """About the `n` rows of each group with the smallest `by`, a 64-bit hash; never more.

    Groups are counted first, and only the share of rows that holds some SPARE * n of each is ranked, so that the task
    of a group stays bounded however large the group is. The counts, a row for each group, are broadcast; groups are
    classes of a model, so they are few. Null groups are left out.
    """
    rows = rows.filter(F.col(group).isNotNull())
    counts = rows.groupBy(group).count().withColumnRenamed("count", "_count")
    place = F.pmod(F.col(by), F.lit(_STEPS)) / _STEPS
    few = rows.join(F.broadcast(counts), group).filter(place * F.col("_count") <= SPARE * n).drop("_count")
    order = Window.partitionBy(group).orderBy(place, by)
    return few.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")
