"""Unions, differences, ordering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def concat_drop_duplicates(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames).distinct()


def union_all_relabel(a: DataFrame, b: DataFrame, mapping: dict[str, str], consts: dict[str, object]) -> DataFrame:
    """Append `b` to `a`: columns renamed by {target: source}, constants added, everything else null."""
    shaped = b.select(*[F.col(s).alias(t) for t, s in mapping.items()], *[F.lit(v).alias(c) for c, v in consts.items()])
    return a.unionByName(shaped, allowMissingColumns=True).select(*a.columns)


def union_relations(
    frames: dict[str, DataFrame], include: Sequence[str] | None = None, exclude: Sequence[str] = (),
    source_column: str | None = "source_relation",
) -> DataFrame:
    """Union by name with nulls for missing columns and the name of the source."""

    def shaped(name: str, df: DataFrame) -> DataFrame:
        cols = [c for c in df.columns if c not in exclude and (include is None or c in include)]
        source = [F.lit(name).alias(source_column)] if source_column else []
        return df.select(*source, *cols)

    return reduce(
        lambda x, y: x.unionByName(y, allowMissingColumns=True), [shaped(n, df) for n, df in frames.items()]
    )


def multi_source_union(frames: dict[str, DataFrame], tag_col: str) -> DataFrame:
    """Same table from several sites, tagged with the site."""
    return union_relations(frames, source_column=tag_col)


def except_equality(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one relation and not in the other, with multiplicity; empty when equal.

    One count per distinct row over both relations, so one shuffle answers both directions.
    """
    cols = a.columns
    both = a.select(*cols).withColumn("__n", F.lit(1)).unionByName(b.select(*cols).withColumn("__n", F.lit(-1)))
    counted = both.groupBy(*cols).agg(F.sum("__n").alias("__d")).filter(F.col("__d") != 0)
    side = F.when(F.col("__d") > 0, "a_minus_b").otherwise("b_minus_a")
    return counted.select(side.alias("which_diff"), *cols, F.abs("__d").alias("times"))


def order_limit_offset(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of the ordered rows: a top-k per task, then k rows to one."""
    return df.orderBy(*order).offset(offset).limit(limit)


def natural_key(c: str) -> Column:
    """Sort key in which numbers inside text compare as numbers of any length: each run of digits, without leading
    zeros, follows its length."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), F.lit(1))

    def keyed(t: Column) -> Column:
        number = F.ltrim(t, F.lit("0"))
        return F.when(t.rlike(r"^\d+$"), F.concat(F.lpad(F.length(number).cast("string"), 10, "0"), number)).otherwise(t)

    return F.array_join(F.transform(tokens, keyed), "")


def natural_sort(df: DataFrame, c: str, *ties: str) -> DataFrame:
    """Rows in natural order of `c`, then of its text, then of `ties`."""
    return df.orderBy(natural_key(c), c, *ties)


def pending_queue(
    df: DataFrame, status: str, wanted: str, order: Sequence[Column], n: int = 100
) -> DataFrame:
    """First `n` notifications in a state (oldest pending, latest failed)."""
    return df.filter(F.col(status) == wanted).orderBy(*order).limit(n)
