"""Membership sketches of key columns (Bloom filters) as DataFrames.

A sketch is a bit field kept as rows (word, field) of 64 bits each; words
without a bit are left out. A key sets ``HASHES`` bits. Building one is a
partially aggregated ``bit_or`` per word and asking one is a join on the word, so
neither passes through a single task or the driver, whatever the sizes.

A key that was built in is always found; any other one is found by mistake with
a probability that ``BITS_PER_ROW`` bounds (0.024 where every row has a key of
its own, far less where rows share keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_ROW = 8
LEAST_BITS = 4096


def bits_for(rows: int) -> int:
    """Size of the sketch of a part with this many rows: a power of two."""
    return max(LEAST_BITS, 1 << (BITS_PER_ROW * max(rows, 1) - 1).bit_length())


def _places(key: str, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.col(key), F.lit(i)), bits) for i in range(HASHES)])


def build_sketch(df: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, field) over the non-null values of ``key``."""
    at = df.where(F.col(key).isNotNull()).select(F.explode(_places(key, F.lit(bits).cast("long"))).alias("at"))
    word, bit = F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 AS int))")
    return at.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("field"))


def probable_members(keys: DataFrame, key: str, sketches: list[tuple[DataFrame, int]]) -> DataFrame:
    """(part, key): values of ``keys`` that sketch number ``part`` may hold.

    ``sketches``: (sketch, its bits) each, as many as there are parts of a table."""
    sizes = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(bits).cast("long").alias("bits")) for i, (_, bits) in enumerate(sketches)])
    asked = keys.select(key).where(F.col(key).isNotNull()).distinct().select(key, F.inline(sizes))
    asked = asked.select("part", key, F.explode(_places(key, F.col("bits"))).alias("at"))
    asked = asked.select("part", key, F.shiftright("at", 6).alias("word"), F.expr("cast(at & 63 AS int)").alias("bit"))
    held = None
    for i, (sketch, _) in enumerate(sketches):
        one = sketch.select(F.lit(i).alias("part"), "word", "field")
        held = one if held is None else held.unionByName(one)
    met = asked.join(held, ["part", "word"]).where("getbit(field, bit) = 1")
    return met.groupBy("part", key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).select("part", key)
