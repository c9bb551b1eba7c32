"""Duplicate elimination that holds when one key owns a large share of all rows.

``arrival`` is a column that orders rows by arrival and is unique per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.fixed import PAGE_SIZE
from repotide.operators.filters import countable

NO_LANGUAGE, NO_KEY, DUPLICATE = "no language", "no key", "duplicate"


def content_key(text: Column) -> Column:
    """A 32-byte stand-in for a text used as a key, so that state and shuffles stay small."""
    return F.unhex(F.sha2(text, 256))


def top_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key, with their ``rank``.

    Catalyst puts a group limit in front of the shuffle, so every task sends at most ``n`` rows
    of a key, however many it holds.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def first_seen(rows: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The earliest row of each key; meant for rows of a few narrow columns."""
    return top_rows(rows, keys, [F.col(arrival)], 1).drop("rank")


def first_arrivals(rows: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Arrival of the earliest row of each key: one hash aggregate over two columns."""
    return rows.groupBy(*keys).agg(F.min(arrival).alias("first_arrival")).select("first_arrival")


def first_seen_wide(rows: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Like ``first_seen`` for rows that carry long texts.

    The winners are found on the key and arrival columns alone and then picked from the rows by
    their unique arrival. Long texts are never sorted by key, and no key can make that join
    uneven.
    """
    winners = first_arrivals(rows, keys, arrival)
    return rows.join(winners, F.col(arrival) == F.col("first_arrival"), "left_semi")


def first_per_batch(rows: DataFrame, batch: str, keys: Sequence[str], arrival: str) -> DataFrame:
    """The earliest row of each key within its own batch or poll; later batches start afresh."""
    return first_seen(rows, [batch, *keys], arrival)


def missing_reason(key: str) -> Column:
    """Why a row can't be accepted whatever came before; null if it can."""
    return F.when(F.col("language").isNull(), NO_LANGUAGE).when(F.col(key).isNull(), NO_KEY)


def rejected_rows(repos: DataFrame, key: str, arrival: str) -> DataFrame:
    """The rows deduplication drops, with the reason; here ``arrival`` may repeat or be missing.

    A row without a language or a key is never accepted. A missing arrival is later than any other, and of
    rows with one key and arrival all but one are dropped. The anti-join runs on key and arrival, so a key
    with very many copies spreads over all tasks.
    """
    winners = countable(repos, key).groupBy(F.col(key).alias("_key")).agg(F.min(arrival).alias("_first"))
    alike = Window.partitionBy(key, arrival, F.col("language").isNull()).orderBy(arrival)
    won = (
        (F.col(key) == F.col("_key"))
        & F.col(arrival).eqNullSafe(F.col("_first"))
        & F.col("language").isNotNull()
        & (F.col("_copy") == 1)
    )
    numbered = repos.withColumn("_copy", F.row_number().over(alike))
    reason = F.coalesce(missing_reason(key), F.lit(DUPLICATE))
    return numbered.join(winners, won, "left_anti").drop("_copy").withColumn("reason", reason)


def newest_pushes(pushes: DataFrame, batch: Sequence[str]) -> DataFrame:
    """One row per repository and batch (or poll) with its newest push in there."""
    return countable(pushes).groupBy(*batch, "language", "id").agg(F.max("pushed_at").alias("pushed_at"))


def latest_page(pushes: DataFrame, poll: str, size: int = PAGE_SIZE) -> DataFrame:
    """What one poll per language returns: its ``size`` most recently pushed repositories."""
    newest = newest_pushes(pushes, [poll])
    return top_rows(newest, [poll, "language"], [F.desc("pushed_at"), F.col("id")], size)
