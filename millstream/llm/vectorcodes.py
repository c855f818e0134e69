"""Codes of vectors by product quantisation, with codebooks fitted by active-entry Lloyd rounds.

A vector is cut into equal consecutive parts; each part position has a codebook, and the code of a part is the index of
its nearest entry. Every round assigns all parts and then moves each entry to the mean of its parts.

The assignments are a table with the exact distance of every part to its entry. Once an entry has moved, a part whose
own entry stayed where it was needs only the moved entries: all others are as far as before, so none of them can beat the
stored distance. Parts whose own entry moved are compared with the whole codebook. Ties go to the lower index on both ways.

All numbers are whole, so that distances and means don't depend on the order of the rows or on how they are dealt out.
The driver holds the codebooks only (entries x components numbers), and a task sends one row of sums for each entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns, bound_batches
from millstream.session import stored


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of `width`, short lists filled up with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    made = np.zeros((len(sizes), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = flat
    return made


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by entries: in floating point while every term is exact there."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 2**53:
        a, b = x.astype(float), book.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return sum((x[:, k, None] - book[None, :, k]) ** 2 for k in range(x.shape[1]))


def rescan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of each row: the nearest entry, of equally near ones the lowest."""
    far = distances(x, book)
    code = far.argmin(1)
    return code, far[np.arange(len(x)), code]


def update(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `rescan`, from the codes and distances to the codebook before its entries `moved` (a mask) changed."""
    code, far = code.copy(), far.copy()
    again = moved[code]
    if again.any():
        code[again], far[again] = rescan(x[again], book)
    stayed, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(stayed) and len(active):
        near, least = rescan(x[stayed], book[active])
        near = active[near]
        better = (least < far[stayed]) | (least == far[stayed]) & (near < code[stayed])
        code[stayed[better]], far[stayed[better]] = near[better], least[better]
    return code, far


def _assign(state: DataFrame, books: np.ndarray, moved: np.ndarray | None, v: str, codes: str, errors: str) -> DataFrame:
    """`state` with codes and errors by the codebooks (parts, entries, width). moved: None if no codes are there yet."""
    parts, _, width = books.shape

    def start():
        def work(columns: list[pa.Array]) -> list[pa.Array]:
            x = _matrix(columns[0], parts * width).reshape(-1, parts, width)
            code, far = (_matrix(c, parts) for c in columns[1:]) if moved is not None else np.zeros((2, len(x), parts), np.int64)
            made = [rescan(x[:, p], books[p]) if moved is None else update(x[:, p], books[p], moved[p], code[:, p], far[:, p]) for p in range(parts)]
            return [_lists(np.stack([m[i] for m in made], 1), kind) for i, kind in enumerate((pa.int32(), pa.int64()))]

        return work

    fields = [T.StructField(codes, T.ArrayType(T.IntegerType())), T.StructField(errors, T.ArrayType(T.LongType()))]
    return add_columns(state, [v] if moved is None else [v, codes, errors], fields, start)


def _means(state: DataFrame, books: np.ndarray, v: str, codes: str) -> np.ndarray:
    """The codebooks with every entry that has parts at their mean, rounded down."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts * width).reshape(-1, parts, width)
            code = _matrix(batch.column(1), parts)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=entries)
                for k in range(width):  # sums of one batch are exact in floating point
                    sums[p, :, k] += np.bincount(code[:, p], weights=x[:, p, k], minlength=entries).astype(np.int64)
        at = np.flatnonzero(n.ravel())
        rows = sums.reshape(-1, width)[at]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.ravel()[at]), _lists(rows, pa.int64())], names=["at", "n", "sums"])

    bound_batches(state.sparkSession)
    each = state.select(v, codes).mapInArrow(run, "at long, n long, sums array<long>")
    found = each.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(width)])
    made = books.copy()
    for r in found.collect():  # a row for each entry
        made[r["at"] // entries, r["at"] % entries] = [r[f"s{k}"] // r["n"] for k in range(width)]
    return made


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2,
    scale: int = 256, codes: str = "codes", errors: str = "errors",
) -> tuple[DataFrame, np.ndarray]:
    """(rows, books): the rows whose vector is there and finite, with `codes` (an entry's index for each part) and `errors`
    (its squared distance), and the final codebooks as whole numbers (parts, entries, width).

    Components become floor(scale * x). The codebooks begin with the parts of the rows with the `entries` smallest keys
    (null keys last; rows that share a key by their vector); with fewer rows there are fewer entries. An entry without
    parts stays where it is. Other columns pass unchanged; columns named as the new ones are replaced. Repeated rows count
    each. Vectors that are shorter than the longest, and lengths that `parts` doesn't divide, are filled up with zeros.
    Components so large that a vector's distance may not fit in 63 bits are taken as the largest that does (about a
    million for 64 components). An empty table gives no rows and codebooks without entries.
    """
    kept = vectors.filter(finite(vector))
    longest = kept.agg(F.max(F.size(vector))).first()[0] or 0
    width = -(-longest // parts)
    top = float(math.isqrt((1 << 62) // max(1, longest)) // 2)
    own = "_" * max(map(len, vectors.columns))
    v = f"{own}v"
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), x.cast("double") * scale))).cast("int"))
    rest = [F.col(f"`{c}`") for c in vectors.columns if c.lower() not in (codes.lower(), errors.lower())]
    state = stored(kept.select(*rest, whole.alias(v)), "vectors")
    first = state.select(F.col(f"`{key}`").alias("k"), F.col(v).alias("v")).orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for row, r in zip(start, first):
        row[: len(r["v"])] = r["v"]
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    if not len(first):
        empty = [F.array().cast("array<int>").alias(codes), F.array().cast("array<long>").alias(errors)]
        return state.select("*", *empty).drop(v), books
    moved = None
    for _ in range(rounds):
        state = stored(_assign(state, books, moved, v, codes, errors), "vectors")
        made = _means(state, books, v, codes)
        moved, books = (made != books).any(2), made
    return stored(_assign(state, books, moved, v, codes, errors).drop(v), "vectors"), books
