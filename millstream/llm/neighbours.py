"""Columns made from a row and the row that follows it in an order of the whole table.

The table is dealt out by ranges of the order and sorted within them once, so that most rows find the next one in their
own task. Only the first and the last row of a range meet those of other ranges, in a second step over two rows a range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import bound_batches
from millstream.session import stored

Work = Callable[[list[pa.Array], list[pa.Array]], list[pa.Array]]


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """`df` dealt out by ranges of `order`, sorted within them; equal rows may lie in several ranges, one after the other."""
    place = "_" * max(map(len, df.columns)) + "place"
    rows = df.withColumn(place, F.monotonically_increasing_id())
    return rows.repartitionByRange(*order, F.col(place)).sortWithinPartitions(*order, F.col(place)).drop(place)


def add_from_next(ordered: DataFrame, inputs: Sequence[str], fields: Sequence[T.StructField], start: Callable[[], Work], keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with the new `fields`, which come from the `inputs` of the row and of the next one.

    ordered: of `in_order`, perhaps with columns added row by row. The last row's next is the first one; a single row is
    followed by itself. start() runs once in each worker and returns work(own, next), which gets the input columns of both.
    keep and fields don't share names.
    """
    kept, given = [ordered.schema[c] for c in keep], [ordered.schema[c] for c in inputs]
    own = "_" * max(map(len, [*ordered.columns, *[f.name for f in fields]]))
    part, end = f"{own}part", f"{own}end"
    asked = [T.StructField(f"{own}{i}", f.dataType) for i, f in enumerate(given)]
    schema = T.StructType([*kept, *fields, T.StructField(part, T.IntegerType()), T.StructField(end, T.IntegerType()), *asked])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, here, first, last = start(), TaskContext.get().partitionId(), None, None

        def rows(left: list[pa.Array], made: list[pa.Array], number: int, shown: list[pa.Array]) -> pa.RecordBatch:
            marks = [pa.array([x] * len(made[0]), pa.int32()) for x in (here, number)]
            return pa.RecordBatch.from_arrays([*left, *made, *marks, *shown], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if last is None else pa.concat_tables([last, table])
            columns = [pa.concat_arrays(c.chunks) for c in table.columns]
            size = table.num_rows - 1
            made = work([c.slice(0, size) for c in columns[n:]], [c.slice(1) for c in columns[n:]])
            first = [c.slice(0, 1) for c in columns] if first is None else first
            last, end = table.slice(size), [c.slice(size) for c in columns]
            if size:
                yield rows([c.slice(0, size) for c in columns[:n]], made, 0, _nulls(columns[n:], size))
        if first is not None:
            blank = _nulls(made, 1)
            yield rows(end[:n], blank, 1, end[n:])
            yield rows(_nulls(first[:n], 1), blank, 2, first[n:])

    bound_batches(ordered.sparkSession)
    names = [F.col(f"`{c}`").alias(f"{own}{own}{i}") for i, c in enumerate([*keep, *inputs])]
    found = stored(ordered.select(*names).mapInArrow(run, schema), "neighbours")
    done = found.filter(F.col(end) == 0).select(*keep, *[f.name for f in fields])
    tails = found.filter(F.col(end) == 1).select(part, *[f"`{c}`" for c in keep], *[F.col(a.name).alias(f"{own}a{i}") for i, a in enumerate(asked)])
    heads = found.filter(F.col(end) == 2).select(F.col(part).alias(f"{own}to"), *[F.col(a.name).alias(f"{own}b{i}") for i, a in enumerate(asked)])
    # A row for each range, so one task may see them all.
    ranges = found.filter(F.col(end) == 2).select(part)
    after = ranges.withColumn(f"{own}to", F.lead(part).over(Window.orderBy(part)))
    after = after.crossJoin(ranges.agg(F.min(part).alias(f"{own}first"))).select(part, F.coalesce(f"{own}to", f"{own}first").alias(f"{own}to"))
    ends = tails.join(after, part).join(heads, f"{own}to")
    k, width = len(asked), len(fields)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(batch.columns[n : n + k], batch.columns[n + k :])
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=[*keep, *[f.name for f in fields]])

    sent = ends.select(*[F.col(f"`{c}`").alias(f"{own}{own}{i}") for i, c in enumerate(keep)], *[f"{own}a{i}" for i in range(k)], *[f"{own}b{i}" for i in range(k)])
    return done.unionByName(sent.mapInArrow(finish, T.StructType(schema.fields[: n + width])))


def _nulls(like: Sequence[pa.Array], size: int) -> list[pa.Array]:
    return [pa.nulls(size, c.type) for c in like]
