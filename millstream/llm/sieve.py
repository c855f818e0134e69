"""A bit table of fixed size over whole numbers: tells most rows that have no partner without a shuffle.

It never rejects a number that it holds. However many numbers go in, the driver gets 2^BITS bits and the plan holds
them once; a full table only lets more rows through to the exact join behind it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstream.session import stored

BITS = 21
_PART = 32768  # bits of one bitmap


def sieve(numbers: DataFrame, column: str, bits: int = BITS) -> Callable[[Column], Column]:
    """Test for a long column: false only where the number isn't among those of `numbers`. bits: 15 at least. Runs a job."""
    at = F.pmod(F.col(column), F.lit(1 << bits))
    parts = numbers.filter(F.col(column).isNotNull()).select(F.floor(at / _PART).alias("part"), (at % _PART).alias("bit"))
    table = bytearray((1 << bits) // 8)
    for r in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        table[_PART // 8 * r.part : _PART // 8 * (r.part + 1)] = r.bits
    words = F.from_json(F.lit(json.dumps(np.frombuffer(bytes(table), "<i8").tolist())), "array<bigint>")

    def within(number: Column) -> Column:
        place = F.pmod(number, F.lit(1 << bits))
        return F.call_function("shiftright", F.get(words, F.floor(place / 64).cast("int")), (place % 64).cast("int")).bitwiseAND(1) == 1

    # A list of one binds the number to a name, so that what it is made from is worked out once.
    return lambda number: F.exists(F.array(number), within)


def keeper(numbers: DataFrame, column: str, bits: int = 23) -> Callable[..., DataFrame]:
    """As `sieve` for whole rows: keep(df, number) has the rows of `df` whose number may be among those of `numbers`, and
    keep(df, number, False) the others, null numbers with them.

    The bits are a table of 2^bits / 64 rows at most, which is broadcast (2 MB for 2^23, 8 MB for 2^25), so plans hold no large literal.
    """
    place = F.pmod(F.col(column), F.lit(1 << bits))
    parts = numbers.filter(F.col(column).isNotNull()).select(F.floor(place / 64).cast("int").alias("_word"), (place % 64).cast("int").alias("_at"))
    words = stored(parts.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_at"))).alias("_bits")), "sieve")

    def keep(df: DataFrame, number: Column, held: bool = True) -> DataFrame:
        own = "_" * max(map(len, df.columns))
        word, at, bit = f"{own}word", f"{own}at", f"{own}bits"
        placed = df.withColumn(at, F.pmod(number, F.lit(1 << bits))).withColumn(word, F.floor(F.col(at) / 64).cast("int"))
        table = words.select(F.col("_word").alias(word), F.col("_bits").alias(bit))
        found = placed.join(F.broadcast(table), word, "inner" if held else "left")
        there = F.call_function("shiftright", F.col(bit), (F.col(at) % 64).cast("int")).bitwiseAND(1) == 1
        return found.filter(there if held else ~F.coalesce(there, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns])

    return keep
