"""Reading tables, text and JSON."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.functions.timekeys import as_ntz
from millstream.functions.wallclock import col


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def range_extract(df: DataFrame, cols: Sequence[str], delta_col: str, start, end) -> DataFrame:
    """Rows whose delta column lies in [start, end]. A plain predicate, so it reaches the Parquet or JDBC scan."""
    at = F.col(delta_col)
    return df.filter((at >= as_ntz(start)) & (at <= as_ntz(end))).select(*cols)


def jdbc_range_extract(
    spark: SparkSession, url: str, source: str, cols: Sequence[str], delta_col: str, bounds: Sequence[dt.datetime],
    properties: dict[str, str],
) -> DataFrame:
    """The same from a database: consecutive `bounds` become one predicate, hence one partition and one connection
    each; the last bound is included."""
    predicates = range_predicates(delta_col, bounds, url)
    return spark.read.jdbc(url, source, predicates=predicates, properties=properties).select(*cols)


def time_literal(at: dt.datetime, url: str) -> str:
    """A time with its microseconds in the dialect of a JDBC address: quoted text where there are no typed literals."""
    text = at.strftime("%Y-%m-%d %H:%M:%S") + (f".{at.microsecond:06d}" if at.microsecond else "")
    return f"'{text}'" if url.startswith(("jdbc:sqlserver:", "jdbc:jtds:")) else f"TIMESTAMP '{text}'"


def range_predicates(delta_col: str, bounds: Sequence[dt.datetime], url: str) -> list[str]:
    """One predicate for each pair of neighbouring bounds."""
    text = [time_literal(b, url) for b in bounds]
    return [
        f"{delta_col} >= {a} AND {delta_col} {'<=' if i == len(text) - 2 else '<'} {b}" for i, (a, b) in enumerate(zip(text, text[1:]))
    ]


def or_range_extract(df: DataFrame, ts_cols: Sequence[str], start, end) -> DataFrame:
    """Rows with any of the times in [start, end]: event time or a late edit."""
    hit: Column = F.lit(False)
    for c in ts_cols:
        hit = hit | ((F.col(c) >= as_ntz(start)) & (F.col(c) <= as_ntz(end)))
    return df.filter(hit)


def coalesced_event_time(df: DataFrame, ts_cols: Sequence[str | Column], out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(*[col(c) for c in ts_cols]))


def enriched_extract(fact: DataFrame, dim: DataFrame, key: str, defaults: dict[str, str], how: str = "left") -> DataFrame:
    """Facts with dimension columns; missing ones take the defaults."""
    joined = fact.join(dim.select(key, *defaults), key, how)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def csv_routes(lines: DataFrame, routes: dict[str, Sequence[str]], line: str = "value", sensor_at: int = 2) -> dict[str, DataFrame]:
    """Typed frames from text lines, routed by the prefix of the sensor field.

    `routes` maps a prefix to the column names of its lines; the first five are text, the rest numbers. Lines with
    another number of fields belong to no route.
    """
    fields = F.split(F.col(line), ",")
    out = {}
    for prefix, cols in routes.items():
        fits = (F.size(fields) == len(cols)) & F.trim(F.get(fields, F.lit(sensor_at))).startswith(prefix)
        typed = [
            (F.trim(F.get(fields, F.lit(i))) if i < 5 else F.trim(F.get(fields, F.lit(i))).try_cast("double")).alias(c)
            for i, c in enumerate(cols)
        ]
        out[prefix] = lines.filter(fits).select(*typed)
    return out


def csv_scan(spark: SparkSession, path: str, routes: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    return csv_routes(spark.read.text(path), routes)


def filter_numeric_key(df: DataFrame, c: str) -> DataFrame:
    """Rows whose key consists of digits only."""
    return df.filter(F.col(c).cast("string").rlike("^[0-9]+$"))


def name_parts(path: Column, parts: Sequence[str], sep: str = "_") -> dict[str, Column]:
    """Fields packed in a file name: separator-split stem, one column per part."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    pieces = F.split(stem, sep)
    return {p: F.get(pieces, F.lit(i)) for i, p in enumerate(parts)}


#: Fields of a raw file's name.
FILE_FIELDS = ("factory", "connection", "ip", "category", "table", "start", "end")


def csv_load_by_filename(
    spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str] = FILE_FIELDS, sep: str = "_", level: int = -1
) -> DataFrame:
    """CSV files with the fields of their names as columns. level: which part of the path holds them, the file's name
    itself or, with -2, its folder's, without a leading `name=`."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), level), "^[^=/]*=", "")
    if level != -1:
        name = F.concat(name, F.lit(".csv"))  # a folder's name has no ending to cut
    return df.withColumns(name_parts(name, parts, sep))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Listing (path, length, modificationTime) without reading contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime")


def file_date_filter(
    files: DataFrame, start: dt.date, end: dt.date, path: str = "path", size: str | None = "length",
    min_size: int | None = None, max_size: int | None = None,
) -> DataFrame:
    """Files whose name holds a date _yyyyMMdd_ (or _yyyyMMddHH_) in [start, end], within the size bounds."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    digits = F.regexp_extract(name, r"_(\d{8})(?:\d{2})?(?:_|\.|$)", 1)
    kept = files.withColumn("file_date", F.try_to_date(digits, "yyyyMMdd"))
    kept = kept.filter((F.col("file_date") >= F.lit(start)) & (F.col("file_date") <= F.lit(end)))
    if min_size is not None:
        kept = kept.filter(F.col(size) >= min_size)
    if max_size is not None:
        kept = kept.filter(F.col(size) <= max_size)
    return kept


TEMP = "struct<avg:double,max:double,min:double,diff:double,t90th:double>"
POINT = "struct<x:int,y:int>"
AREA = f"struct<id:int,name:string,temp:{TEMP},max_loc:{POINT},p1:{POINT},p2:{POINT}>"
THERMAL_SCHEMA = (
    f"struct<plant:string,location:string,device:string,timestamp:string,"
    f"frame:struct<temp:{TEMP},max_loc:{POINT}>,roi:array<{AREA}>,box:array<{AREA}>>"
)


def nested_json_flatten(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frame, roi, box) rows of thermal documents, each with device, ymd and hms. Unreadable text drops out."""
    doc = df.select(F.from_json(text, F.lit(THERMAL_SCHEMA)).alias("d")).filter("d.device is not null")
    at = F.try_to_timestamp("d.timestamp").cast("timestamp_ntz")
    head = [
        F.col("d.plant").alias("plant"), F.col("d.device").alias("device"),
        F.date_format(at, "yyyyMMdd").alias("ymd"), F.date_format(at, "HHmmss").alias("hms"),
    ]
    frame = doc.select(*head, "d.frame.temp.*", F.col("d.frame.max_loc.x").alias("x"), F.col("d.frame.max_loc.y").alias("y"))

    def areas(c: str) -> DataFrame:
        rows = doc.select(*head, F.explode(f"d.{c}").alias("a"))
        return rows.select(
            "plant", "device", "ymd", "hms", F.col("a.id").alias("area_id"), "a.name", "a.temp.*",
            F.col("a.max_loc.x").alias("x"), F.col("a.max_loc.y").alias("y"),
        )

    return frame, areas("roi"), areas("box")


def conform_to_schema(df: DataFrame, schema: T.StructType, drop: Sequence[str] = ()) -> DataFrame:
    """Columns of the target in its order and types; extras go, missing ones are null."""
    have = set(df.columns) - set(drop)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
            if f.name not in drop
        ]
    )


def append_audit_cols(df: DataFrame, extract_at, ingest_at) -> DataFrame:
    return df.withColumns({"etl_extract_time": as_ntz(extract_at), "etl_ingest_time": as_ntz(ingest_at)})
