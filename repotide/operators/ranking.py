"""Rankings, short lists and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.fixed import HISTORY_LENGTH, TOP_WORDS
from repotide.functions.text import pairs_text
from repotide.functions.times import batch_start
from repotide.operators.dedup import top_rows


def ranked_words(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` most frequent words per language with their rank; ties go by word."""
    return top_rows(counts, ["language"], [F.desc("freq"), F.col("word")], n)


def as_shown(ranked: DataFrame) -> DataFrame:
    """Ranked words under the column names of the dashboard."""
    return ranked.select(*(F.col(name).alias(name.title()) for name in ("language", "word", "freq")))


def top_words(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    return as_shown(ranked_words(counts, n))


def word_lists(ranked: DataFrame) -> DataFrame:
    """One row per language with its ranked words; at most the top list is gathered per row."""
    entry = F.struct("rank", "word", "freq")
    lists = ranked.groupBy("language").agg(F.sort_array(F.collect_list(entry)).alias("words"))
    return lists.select("language", pairs_text(F.col("words"), "word", "freq").alias("words"))


def first_rows(rows: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a given order: a per-task top-n and one small merge."""
    return rows.orderBy(*order).limit(n)


def last_values(series: DataFrame, key: str, time: str, n: int = HISTORY_LENGTH) -> DataFrame:
    """The ``n`` latest rows of each key's history; rank 1 is the newest."""
    return top_rows(series, [key], [F.desc(time)], n)


def latest_rows(rows: DataFrame, time: str, seconds: int) -> DataFrame:
    """The rows of the latest batch of ``seconds``.

    The bound is on the time column as stored, so a scan can skip whatever lies before it.
    """
    newest = rows.agg(F.max(time).alias("newest"))
    return rows.where(F.col(time) >= newest.select(batch_start(F.col("newest"), seconds)).scalar())


def last_batches(
    rows: DataFrame, time: str, seconds: int, n: int = HISTORY_LENGTH
) -> DataFrame:
    """The rows since the ``n`` latest batches of ``seconds`` that hold any row.

    The bound comes from a narrow pass over the distinct batches and, as above, lets a scan skip
    the rest.
    """
    starts = rows.select(batch_start(F.col(time), seconds).alias("start")).distinct()
    last = first_rows(starts, n, F.desc("start"))
    return rows.where(F.col(time) >= last.agg(F.min("start")).scalar())


def newest_by_key(updates: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """The last state of each key in a log of updates."""
    values = [name for name in updates.columns if name not in (*keys, batch)]
    return updates.groupBy(*keys).agg(*(F.max_by(name, batch).alias(name) for name in values))
