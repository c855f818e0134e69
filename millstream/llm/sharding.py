"""Shards of bounded size by extendible hashing.

A row's address is a hash of its key, then one of its content. A directory indexed by the first bits of the address
holds the buckets; a bucket that is larger than the limit is split on another bit, and only it. Sizes of buckets at
several depths come from one pass over fine cells, so that a round goes many bits deep. Rows that no address tells
apart, as they repeat key and content, are split by the part of the input that they lie in. A row alone above the limit
has a shard of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millstream.session import stored

#: Bits of each half of an address, and those that a round goes beyond the depth that even buckets need.
BITS, MORE = 60, 4


def _bits(text):
    """The first 60 bits of a text's MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(depth: int, h1: str = "h1", h2: str = "h2"):
    """The first `depth` bits of an address of two halves, as text of zeros and ones."""
    own = F.lpad(F.bin(h1), BITS, "0")
    return F.substring(own if depth <= BITS else F.concat(own, F.lpad(F.bin(h2), BITS, "0")), 1, depth)


def assign(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text", shard: str = "shard") -> DataFrame:
    """`docs` with `shard` (the bits of its bucket), `shard_rows` and `shard_bytes` (columns replaced if there).

    A row counts the bytes of its text in UTF-8; null and empty texts count none, and a null key is as an empty one.
    Every shard has at most `limit` bytes, but for a single row that has more. With no more than `limit` bytes in all
    there is one shard, of no bits. Rows that repeat key and text wholly, of which there may be more than fit, lie in
    shards whose names end in numbers after a dash.
    """
    kept = docs.drop(shard, "shard_rows", "shard_bytes")
    own = "_" * max(map(len, kept.columns))  # no column has such a name with a letter after it
    h1, h2, size, part = (f"{own}{x}" for x in ("h1", "h2", "bytes", "part"))
    id_text, content = F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = kept.withColumns({h1: _bits(id_text), h2: _bits(content), size: F.octet_length(content).cast("long"), part: F.spark_partition_id()})
    sizes = stored(rows.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), F.col(size).alias("bytes")), "shard-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    step = max(1, math.ceil(math.log2(max(total / limit, 1))) + MORE)
    depth, floor, leaves, large = step, 0, [], sizes
    while True:
        # Fine cells of all rows that have no bucket yet, then the size of every bucket above them at once.
        cells = large.groupBy(_prefix(depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        buckets = cells.select("*", F.explode(F.sequence(F.lit(floor), F.lit(depth))).alias("d"))
        buckets = buckets.withColumn("bucket", F.expr("substring(cell, 1, d)"))
        fits = buckets.groupBy("d", "bucket").agg(F.sum("bytes").alias("b"), F.sum("n").alias("m")).filter((F.col("b") <= limit) | (F.col("m") == 1))
        # A table of its own, so that the cells of the shallow buckets, which are many to a bucket, can be split over tasks.
        fits = stored(fits, f"shard-fits-{depth}")
        found = buckets.join(fits, ["d", "bucket"]).groupBy("cell").agg(F.min(F.struct("d", "bucket", "m", "b")).alias("leaf"))
        found = stored(cells.select("cell").join(found, "cell", "left"), f"shard-cells-{depth}")
        leaves.append((depth, found.filter("leaf IS NOT NULL").select("cell", "leaf.bucket", "leaf.m", "leaf.b")))
        over = found.filter("leaf IS NULL").select("cell")
        if over.isEmpty() or depth == 2 * BITS:
            break
        large = stored(large.join(over, _prefix(depth) == F.col("cell")).drop("cell"), f"shard-large-{depth}")
        floor, depth = depth + 1, min(depth + step, 2 * BITS)
    out, depths = rows, [d for d, _ in leaves]
    for d, found in leaves:
        at = found.select(*[F.col(a).alias(f"{own}{b}{d}") for a, b in (("cell", "cell"), ("bucket", "s"), ("m", "m"), ("b", "b"))])
        out = out.join(at, _prefix(d, h1, h2) == F.col(f"{own}cell{d}"), "left")
    made = {shard: "s", "shard_rows": "m", "shard_bytes": "b"}
    named = out.withColumns({a: F.coalesce(*[F.col(f"{own}{b}{d}") for d in depths]) for a, b in made.items()})
    result = [*kept.columns, *made]
    if over.isEmpty():
        return named.select(*result)
    # Copies that share the whole address: as many to a shard as fit, counted in each part of the input by itself.
    plain, same = named.filter(F.col(shard).isNotNull()), named.filter(F.col(shard).isNull())
    within = Window.partitionBy(h1, h2, part).orderBy(h1)
    place = F.floor((F.row_number().over(within) - 1) / F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col(size))))
    same = same.withColumn(shard, F.concat_ws("-", _prefix(2 * BITS, h1, h2), F.col(part), place))
    each = Window.partitionBy(shard)
    same = same.withColumns({"shard_rows": F.count("*").over(each), "shard_bytes": F.sum(size).over(each)})
    return plain.select(*result).unionByName(same.select(*result))


def write(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text", shard: str = "shard") -> None:
    """Writes the rows as Parquet below `path`, a folder and one file for each shard. A shard fits its limit, so one task writes it."""
    rows = assign(docs, limit, key, text, shard).withColumn(shard, F.concat(F.lit("s"), shard))
    rows.repartition(shard).write.mode("overwrite").partitionBy(shard).parquet(path)
