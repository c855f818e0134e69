"""Exact top-k by inner product with a three-phase uniform threshold.

A vector is cut into slices, and every slice of the table is a list of its own, scored against the queries in blocks of
rows. First each block gives its best entries, from which the exact totals of a few rows set a safe cutoff for each
query: the k-th best of them. Of m slices of a row that reaches the cutoff, at least one reaches an m-th of it; so the
second phase collects the entries that do. Rows whose known slices and the most that the unknown ones can add stay
below the cutoff go, and the third phase works out the totals of the others.

Equal vectors have equal scores, and ties go to the smaller id; so of the rows with one vector only the k + 1 with the
smallest ids can be in a result, and a query vector is worked out once, however many rows have it. Rows are told apart by
a number of their own, as several may have one id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.session import stored

#: Rows of a block of the table and of the queries, and slices of a vector.
ROWS, QUERIES, SLICES = 4096, 1024, 2


def whole_numbers(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v, q): floor(scale * x) of each component, and whether the row is a query.

    Rows without id and vectors that are null or hold a null or non-finite component are left out.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.coalesce(finite, F.lit(False)))
    v = F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    return rows.select(F.col(key).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.array(column.combine_chunks().flatten(), np.int64).reshape(-1, width)


def _products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products, queries by rows: in floating point while every sum is exact there."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    if most < 2**53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


_PARTS = "query long, id long, slice int, part long"


def _entries(query: np.ndarray, ids: np.ndarray, number: int, products: np.ndarray, kept: np.ndarray) -> pa.Table:
    q, r = np.nonzero(kept)
    return pa.table({"query": query[q], "id": ids[r], "slice": pa.array(np.full(len(q), number), pa.int32()), "part": products[q, r]})


def _cells(rows: DataFrame, queries: DataFrame, width: int, row_blocks: int, query_blocks: int):
    """Slices of rows and queries by (slice, block of rows, block of queries), to be scored together."""

    def slices(df: DataFrame, own: Column, other: str, n: int) -> DataFrame:
        df = df.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(other))
        parts = [F.struct(F.lit(s).alias("slice"), F.slice("v", s * width // SLICES + 1, (s + 1) * width // SLICES - s * width // SLICES).alias("w")) for s in range(SLICES)]
        return df.select(*[c for c in df.columns if c != "v"], F.inline(F.array(*parts)))

    left = slices(rows, F.pmod(F.xxhash64("id"), F.lit(row_blocks)), "qb", query_blocks).withColumnRenamed("own", "rb")
    right = slices(queries, F.pmod(F.xxhash64("query"), F.lit(query_blocks)), "rb", row_blocks).withColumnRenamed("own", "qb")
    cell = ["slice", "rb", "qb"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell))


def _totals(pairs: DataFrame, rows: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, id, score) of the pairs, from whole vectors."""
    dot = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    both = pairs.select("query", "id").join(queries.select("query", F.col("v").alias("w")), "query").join(rows.select("id", "v"), "id")
    return both.select("query", "id", dot.alias("score"))


def nearest(numbers: DataFrame, k: int, repeats: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k other rows of the highest inner product.

    numbers: as `whole_numbers` gives them. Ties go to the smaller id; with fewer rows, all. Rows that share an id are
    rows of their own; those that repeat the vector too count once, or with `repeats` each. A vector shorter than the
    longest counts as filled up with zeros. Sums must fit in 64 bits.
    """
    numbers = numbers if repeats else numbers.distinct()
    numbers = numbers.withColumnRenamed("id", "vec").withColumn("id", F.monotonically_increasing_id())
    numbers = stored(numbers, "topk-numbers")
    width = max(SLICES, numbers.agg(F.max(F.size("v"))).first()[0] or 0)
    fill = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    numbers = numbers.withColumn("v", F.when(F.size("v") < width, F.concat("v", fill)).otherwise(F.col("v")))
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec", "id"))
    kept = stored(numbers.withColumn("n", first).filter(F.col("n") <= k + 1).select("id", "vec", "v"), "topk-rows")
    rows = kept.select("id", "v")
    asked = numbers.filter("q").select("id", "vec", "v")
    queries = stored(asked.groupBy("v").agg(F.min("id").alias("query")).select("query", "v"), "topk-queries")
    row_blocks, query_blocks = max(1, -(-rows.count() // ROWS)), max(1, -(-queries.count() // QUERIES))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return _entries(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, np.zeros((0, 0), np.int64), np.zeros((0, 0), bool))
        w = len(left["w"][0])
        products = _products(_matrix(left["w"], w), _matrix(right["w"], w))
        kept = np.zeros(products.shape, bool)
        top = min(k + 1, products.shape[1])
        np.put_along_axis(kept, np.argpartition(-products, top - 1, axis=1)[:, :top], True, axis=1)
        return _entries(np.array(right["query"]), np.array(left["id"]), left["slice"][0].as_py(), products, kept)

    def above(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return best(left, right)
        w = len(left["w"][0])
        products = _products(_matrix(left["w"], w), _matrix(right["w"], w))
        cutoff = -(-np.array(right["cutoff"]) // SLICES)  # an m-th, rounded up: the same for whole numbers
        return _entries(np.array(right["query"]), np.array(left["id"]), left["slice"][0].as_py(), products, products >= cutoff[:, None])

    # 1: the best of each list, and the cutoff from the totals of their rows
    listed = _cells(rows, queries, width, row_blocks, query_blocks).applyInArrow(best, _PARTS)
    place = F.row_number().over(Window.partitionBy("query", "slice").orderBy(F.desc("part"), "id"))
    pairs = listed.withColumn("n", place).filter(F.col("n") <= k + 1).select("query", "id").distinct()
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ranked = _totals(pairs, rows, queries).withColumn("n", place).filter(F.col("n") <= k + 1)
    cutoffs = ranked.groupBy("query").agg(F.min("score").alias("cutoff"))
    cutoffs = stored(queries.join(cutoffs, "query"), "topk-cutoffs")
    # 2: all entries that reach an m-th of it, without those rows that can't reach it in total
    entries = _cells(rows, cutoffs, width, row_blocks, query_blocks).applyInArrow(above, _PARTS)
    known = entries.groupBy("query", "id").agg(F.sum("part").alias("known"), F.count("*").alias("n"))
    able = SLICES * F.col("known") + (SLICES - F.col("n")) * (F.col("cutoff") - 1) >= SLICES * F.col("cutoff")
    able = stored(known.join(cutoffs.select("query", "cutoff"), "query").filter(able), "topk-able")
    # 3: what is still unknown
    exact = able.filter(F.col("n") == SLICES).select("query", "id", F.col("known").alias("score"))
    exact = exact.unionByName(_totals(able.filter(F.col("n") < SLICES), rows, queries))
    order = [F.desc("score"), "vec", "id"]
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    top = exact.join(kept.select("id", "vec"), "id").withColumn("n", place).filter(F.col("n") <= k + 1).drop("n")
    of = asked.select(F.col("id").alias("own"), F.col("vec").alias("query_id"), "v").join(queries, "v").select("own", "query_id", "query")
    others = of.join(top, "query").filter(F.col("id") != F.col("own"))
    place = F.row_number().over(Window.partitionBy("own").orderBy(*order))
    return others.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", F.col("vec").alias("vec_id"), "score")
