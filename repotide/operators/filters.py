"""Row filters and column changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.fixed import POLL_SECONDS, RAISE_B, TRACKED
from repotide.functions.numbers import is_odd
from repotide.functions.text import spread_characters
from repotide.functions.times import batch_end


def with_language(repos: DataFrame) -> DataFrame:
    return repos.where(F.col("language").isNotNull())


def countable(repos: DataFrame, key: str = "id") -> DataFrame:
    """Rows that can stand for a repository: they have a language and a key."""
    return with_language(repos).where(F.col(key).isNotNull())


def with_description(repos: DataFrame) -> DataFrame:
    """Rows that can contribute words; the others still count for totals and stars."""
    return repos.where(F.col("description").isNotNull())


def tracked_only(rows: DataFrame, languages: Sequence[str] = TRACKED) -> DataFrame:
    return rows.where(F.col("language").isin(*languages))


def odd_only(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(is_odd(F.col(column)))


def in_polls(rows: DataFrame, time: str, seconds: int = POLL_SECONDS) -> DataFrame:
    """Rows with the poll round they arrive in, as the column ``poll``."""
    return rows.withColumn("poll", batch_end(F.col(time), seconds))


def raise_b(table: DataFrame, by: int = RAISE_B) -> DataFrame:
    return table.select("A", (F.col("B") + by).alias("B"))


def digits_of_b(table: DataFrame) -> DataFrame:
    return table.select("A", spread_characters(F.col("B")).alias("B"))
