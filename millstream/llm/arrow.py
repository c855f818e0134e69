"""Arrow batches through Python: adds columns to a DataFrame, with batches bounded by bytes as well as rows."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 2 << 20


def release() -> None:
    """Gives memory that a finished task no longer uses back to the system; its worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """A batch sent to Python holds about `limit` bytes at most (one row at least), however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    start: Callable[[], Callable[[list[pa.Array]], list[pa.Array]]],
) -> DataFrame:
    """`df` with the new `fields`; a column of the same name is replaced, all others pass unchanged.

    `start` runs once in each Python worker and returns the function from input arrays to one array per field.
    """
    names = [f.name for f in fields]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    # The inputs go first under names of their own, so that no other column can clash with them.
    own = "_in" + "_" * max(map(len, df.columns))
    sent = df.select(*[F.col(f"`{c}`").alias(f"{own}{i}") for i, c in enumerate(inputs)], *[F.col(f"`{c}`") for c in kept])
    n = len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work([batch.column(i) for i in range(n)])
            yield pa.RecordBatch.from_arrays([*batch.columns[n:], *made], names=[*kept, *names])
        del work
        release()

    bound_batches(df.sparkSession)
    return sent.mapInArrow(run, schema)
