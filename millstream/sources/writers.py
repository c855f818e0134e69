"""Writing tables: append, replace, upsert, CSV, several targets.

Tables are Parquet folders. Those that are upserted have versions (see `snapshots`): an upsert touches only the partitions
that hold incoming keys, and readers see the old version until the new one is whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.operators import joins
from millstream.sources import snapshots
from millstream.session import stored

DYNAMIC = "dynamic"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored there."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one folder together, split again where a folder is large: few files and no hot task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    by_partition(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_slice(df: DataFrame, path: str, slice_cols: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in `df`."""
    by_partition(df, slice_cols).write.mode("overwrite").option("partitionOverwriteMode", DYNAMIC).partitionBy(*slice_cols).parquet(path)


full_refresh_dim = replace_table


def sanitized(df: DataFrame, replacement: str = " ") -> DataFrame:
    """Tabs and line breaks inside text become blanks."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(c, r"[\t\r\n]", replacement) for c in text}) if text else df


def bulk_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    by_partition(sanitized(df), partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def _stored_table(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The stored table with all its columns; those that `new` has too are read with its types, as the types of
    partition columns can't be seen in the files."""
    given = {f.name: f for f in new.schema.fields}
    found = spark.read.parquet(path).schema.fields
    return spark.read.schema(T.StructType([given.get(f.name, f) for f in found])).parquet(path)


#: An upsert makes a new version of a table in one step; `snapshots.read` reads the current one.
upsert = snapshots.upsert


def upsert_do_nothing(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], order: Sequence[Column],
    partition_by: Sequence[str] = (),
) -> None:
    """Stored rows win; only unknown keys are added."""
    new = joins.distinct_on(new, keys, order)
    if not exists(spark, path):
        replace_table(new, path, partition_by)
        return
    old = _stored_table(spark, path, new).select(*keys)
    stored(new.join(old, list(keys), "left_anti"), "added").write.mode("append").partitionBy(*partition_by).parquet(path)


def csv_sink_partitioned(df: DataFrame, path: str, by: Sequence[str], delimiter: str = ",") -> None:
    """CSV with header, one folder per entity; delimiters, quotes and line breaks inside text become blanks."""
    clean = sanitized(df)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in by]
    clean = clean.withColumns({c: F.translate(c, f'{delimiter}"', "  ") for c in text}) if text else clean
    by_partition(clean, by).write.mode("overwrite").partitionBy(*by).option("header", True).option("sep", delimiter).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def multi_sink(df: DataFrame, writers: dict[str, Callable[[DataFrame], None]]) -> dict[str, str]:
    """Write one result to several targets and report each outcome; the result is computed once."""
    ready = stored(df, "sinks")
    status = {}
    for name, write in writers.items():
        try:
            write(ready)
            status[name] = "success"
        except Exception as error:  # one failing target must not stop the others
            status[name] = f"failed: {type(error).__name__}"
    return status
