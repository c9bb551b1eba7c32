"""Readers and generators. Each returns a batch or a streaming DataFrame."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.fixed import NUMBER_MAX, TABLE_BOUND, TABLE_ROWS
from repotide.schemas import AB_TABLE


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as one column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """An unbounded stream of text lines from files arriving in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000
) -> DataFrame:
    """Stream a Parquet table, be it a folder of part files or a single file.

    A streaming source refuses the plain path of a single file but takes a glob,
    so the last character is written as a one-character class.
    """
    head, last = path.rstrip("/")[:-1], path.rstrip("/")[-1]
    glob = f"{head}[{last}]" if re.match(r"\w", last) else path
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(glob)
    )


def read_csv(spark: SparkSession, path: str, schema: str | None = AB_TABLE) -> DataFrame:
    """A CSV table with a header. ``schema=None`` infers types at the price of a second pass."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def integer_range(spark: SparkSession, count: int, partitions: int = 2) -> DataFrame:
    """The integers from 0 below ``count`` over a given number of partitions, column ``id``."""
    return spark.range(0, count, 1, numPartitions=partitions)


def random_table(
    spark: SparkSession, rows: int = TABLE_ROWS, bound: int = TABLE_BOUND, seed: int = 0
) -> DataFrame:
    """Two columns A and B of random integers in [0, bound).

    The seed and the fixed partitions of the range make a recomputed task draw the same values.
    """

    def draw(number: int) -> Column:
        return F.floor(F.rand(seed + number) * bound).cast("int")

    return spark.range(rows).select(draw(0).alias("A"), draw(1).alias("B"))


def random_integers(
    spark: SparkSession, rows_per_second: int = 1, bound: int = NUMBER_MAX
) -> DataFrame:
    """A stream of random integers from 1 to ``bound``, both included.

    Drawn by hashing the row number, so a batch that is run again holds the same numbers.
    """
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select("timestamp", (F.pmod(F.xxhash64("value"), F.lit(bound)) + 1).alias("value"))


def union_streams(feeds: Sequence[DataFrame], time: str, lateness: Sequence[str]) -> DataFrame:
    """One stream of several feeds, each with a watermark of its own.

    What reads it sees the watermark of the feed that is farthest behind, or ahead, as
    ``streaming.queries.start`` is told by ``watermark``. With the former no row is too late because
    another feed is faster, and nothing closes while a feed has never brought a row.
    """
    return union_feeds([feed.withWatermark(time, delay) for feed, delay in zip(feeds, lateness, strict=True)])


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All rows of all feeds, matched by column name; works on streams too."""
    return reduce(DataFrame.unionByName, feeds)
