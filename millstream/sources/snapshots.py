"""Tables whose versions replace each other in one step.

A version is a small list of which folder holds each partition, in one file that is written last. Files that a version
names are never changed, so readers see the old version until the new one is whole, and a write that is killed leaves
folders that no version names. A version that changes few partitions names the old folders for all others.

    {path}/data/v=<number>-<run>/[partition=.../]   rows
    {path}/versions/v=<number>                      the list; the largest number counts

One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.operators import joins
from millstream.operators.chunked import join_null_safe
from millstream.session import stored

#: Up to so many partitions are named in the filter of a scan; more are joined.
NAMED = 1000


def version(spark: SparkSession, path: str) -> int:
    """Number of the current version; 0 if there is none."""
    try:
        return spark.read.parquet(f"{path}/versions").agg(F.max("v")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise


def _list(spark: SparkSession, path: str, number: int) -> tuple[DataFrame, T.StructType, list[str]]:
    """(folder, partition columns) for each partition of a version, its schema and its partition columns."""
    rows = spark.read.parquet(f"{path}/versions/v={number}")
    head = rows.filter("folder IS NULL").first()
    return rows.filter("folder IS NOT NULL").drop("table", "by"), T.StructType.fromJson(json.loads(head.table)), json.loads(head.by)


def _held(rows: DataFrame, places: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose `columns` are those of a row of `places`, by a filter that the scan prunes with where they are few."""
    few = places.select(*columns).distinct().limit(NAMED + 1).collect()
    if len(few) > NAMED:
        return rows.join(places.select(*columns).distinct(), [rows[c].eqNullSafe(places[c]) for c in columns], "left_semi")
    told: Column = F.lit(False)
    for place in few:
        told = told | _equal(place, columns)
    return rows.filter(told)


def _equal(place: Row, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & (F.col(c).isNull() if place[c] is None else F.col(c) == F.lit(place[c]))
    return same


def read(spark: SparkSession, path: str, number: int | None = None, within: DataFrame | None = None) -> DataFrame:
    """The current version, or that of a number, as a DataFrame.

    within: rows with partition columns; then only the partitions that occur there are read.
    """
    number = number or version(spark, path)
    if not number:
        raise ValueError(f"there is no table in {path}")
    places, schema, by = _list(spark, path, number)
    if within is not None and by:
        places = _held(places, within, by)
    folders = [r.folder for r in places.select("folder").distinct().collect()]  # one for each write that still counts
    if not folders:
        return spark.createDataFrame([], schema)
    # Each folder is read for the partitions that it counts for.
    parts = [spark.read.schema(schema).parquet(f"{path}/data/v={f}") for f in folders]
    if not by:
        return parts[0]
    found = [_held(part, places.filter(F.col("folder") == f), by) for part, f in zip(parts, folders)]
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part)
    return rows


def _write(spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, by: Sequence[str], kept: DataFrame | None, number: int, touched: DataFrame | None) -> None:
    """Writes `rows` to a folder of its own and then the list of version `number`: `kept` places and those of the rows."""
    folder = f"{number}-{uuid.uuid4().hex[:12]}"
    dealt = rows.hint("rebalance", *by) if by else rows
    dealt.write.partitionBy(*by).parquet(f"{path}/data/v={folder}")
    if by:
        places = (touched if touched is not None else read_partitions(spark, path, folder, schema, by)).select(F.lit(folder).alias("folder"), *by)
    else:
        places = spark.createDataFrame([(folder,)], "folder string")
    places = places.unionByName(kept) if kept is not None else places
    head = spark.createDataFrame([(json.dumps(schema.jsonValue()), json.dumps(list(by)))], "table string, by string")
    listed = head.unionByName(places, allowMissingColumns=True)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/v={number}")


def read_partitions(spark: SparkSession, path: str, folder: str, schema: T.StructType, by: Sequence[str]) -> DataFrame:
    """The partitions of one written folder."""
    return spark.read.schema(schema).parquet(f"{path}/data/v={folder}").select(*by).distinct()


def replace(spark: SparkSession, path: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
    """A new version that has `rows` only."""
    schema = T.StructType([f for f in rows.schema if f.name not in partition_by] + [rows.schema[c] for c in partition_by])
    _write(spark, path, rows, schema, partition_by, None, version(spark, path) + 1, None)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], order: Sequence[Column], partition_by: Sequence[str] = ()) -> None:
    """A new version in which new rows replace stored rows of the same keys; within `new` the first by `order` counts.

    Only the columns of `new` are replaced: stored columns that it lacks keep their values, and are null in added rows;
    columns that the table lacks are added. Keys must contain the partition columns, so that a key never moves between
    partitions; only partitions with new rows are read and written. Null keys are equal to each other.
    """
    new = joins.distinct_on(new, keys, order)
    number = version(spark, path)
    if not number:
        replace(spark, path, new, partition_by)
        return
    places, schema, by = _list(spark, path, number)
    if list(partition_by) != by:
        raise ValueError(f"the table is partitioned by {by}")
    new = stored(new, "incoming")  # it is read for its partitions, its keys and its rows
    touched = new.select(*by).distinct() if by else None
    old = read(spark, path, number, touched)
    more = [c for c in old.columns if c not in new.columns]
    fresh = join_null_safe(new, old.select(*keys, *more), list(keys), "left") if more else new
    known = new.select(*[F.col(k).alias(f"__n_{k}") for k in keys])
    kept = old.join(known, [old[k].eqNullSafe(known[f"__n_{k}"]) for k in keys], "left_anti")
    merged = fresh.unionByName(kept, allowMissingColumns=True)
    grown = T.StructType([*schema, *[f for f in new.schema if f.name not in schema.names]])
    grown = T.StructType([f for f in grown if f.name not in by] + [grown[c] for c in by])
    rest = None
    if by:
        other = touched.select(*[F.col(c).alias(f"__t_{c}") for c in by])
        rest = places.join(other, [places[c].eqNullSafe(other[f"__t_{c}"]) for c in by], "left_anti")
    _write(spark, path, merged, grown, by, rest, number + 1, touched)
