"""A compact set of numbers seen so far: one bit for each, in bitmaps by bucket.

A bitmap holds 32,768 neighbouring numbers in 4,096 bytes, so the set is small where numbers are dense, as
those given out in order are: an eighth of a byte each at best. Numbers far apart cost a bitmap each; for
those, streaming state by key is the better set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.operators.dedup import first_seen

BITMAPS = "bucket BIGINT, bits BINARY"


def bitmaps(rows: DataFrame, number: str) -> DataFrame:
    """(bucket, bits): the numbers of a column as bitmaps, combined within tasks; nulls are left out."""
    known = rows.where(F.col(number).isNotNull()).select(F.col(number).cast("bigint").alias("n"))
    return known.groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    )


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The numbers that are in either set."""
    return one.unionByName(other).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.get(F.array(*(value.bitwiseAND(1 << i) != 0 for i in range(8))), F.pmod(position, F.lit(8)).cast("int"))


def not_in(rows: DataFrame, number: str, seen: DataFrame) -> DataFrame:
    """The rows whose number is not in the set; rows without a number stay out.

    The bit is looked up by the join itself, so a bitmap is never copied to the rows of its bucket.
    """
    n = F.col(number).cast("bigint")
    held = seen.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    found = (F.bitmap_bucket_number(n) == F.col("_bucket")) & _is_set(F.col("_bits"), F.bitmap_bit_position(n))
    return rows.where(F.col(number).isNotNull()).join(held, found, "left_anti")


def first_of_new(rows: DataFrame, number: str, arrival: str, seen: DataFrame) -> DataFrame:
    """The earliest row of each number of a batch that is not in the set of numbers seen before."""
    return not_in(first_seen(rows.where(F.col(number).isNotNull()), [number], arrival), number, seen)


def size_of(seen: DataFrame) -> DataFrame:
    """(numbers, bytes, bytes_per_number) of a set."""
    numbers, size = F.sum(F.bitmap_count("bits")), F.sum(F.octet_length("bits"))
    return seen.agg(
        F.coalesce(numbers, F.lit(0)).alias("numbers"), F.coalesce(size, F.lit(0)).alias("bytes")
    ).withColumn("bytes_per_number", F.try_divide(F.col("bytes"), F.col("numbers")))
