"""Running results kept in streaming state.

Every stateful operator below combines rows of a key inside each task before the shuffle, so a key
that holds a large share of a batch costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from repotide.fixed import NUMBER_WINDOW_SECONDS, TOP_WORDS
from repotide.functions.numbers import ratio_or_zero
from repotide.operators import seen
from repotide.operators.filters import countable
from repotide.operators.metrics import add_totals, count_by, divisible_counts, star_totals
from repotide.operators.ranking import ranked_words
from repotide.sinks.tables import forget_batches, read_batch, write_batch
from repotide.streaming.queries import BatchFunction

# Snapshots of a running result that are kept besides the newest.
SNAPSHOTS = 10

RUNNING_TOTALS = "language STRING, count BIGINT, stars BIGINT"
RANKED = "language STRING, word STRING, freq BIGINT, rank INT"


def running_counts(stream: DataFrame, *keys: str | Column) -> DataFrame:
    """Count per key since the start; run in complete mode to see every key in every batch."""
    return count_by(stream, *keys)


def windowed_counts(
    stream: DataFrame,
    time: str,
    *keys: str | Column,
    size: int = NUMBER_WINDOW_SECONDS,
    slide: int | None = None,
    lateness: str | None = None,
) -> DataFrame:
    """Count per key in windows of ``size`` seconds, tumbling unless ``slide`` is given.

    Without ``lateness`` state is kept for good and no row is ever too late.
    """
    rows = stream.withWatermark(time, lateness) if lateness else stream
    window = F.window(time, f"{size} seconds", f"{slide or size} seconds")
    return count_by(rows, window, *keys)


def joined_averages(stream: DataFrame, time: str, size: int, lateness: str) -> DataFrame:
    """(window_start, Language, Average_Stars): two running aggregates of one stream, joined.

    Counts and star sums are aggregated per window and language on their own, each behind its
    watermark, and joined when their window closes; in append mode. Both sides drop the same late rows,
    and the join holds a window only until the watermark has passed it. A window has a row per language
    on either side, so the join is as small as its result.
    """
    rows = countable(stream, time).withWatermark(time, lateness)
    window = F.window(time, f"{size} seconds")
    counts = count_by(rows, window, "language")
    stars = rows.groupBy(window, "language").agg(F.sum("stargazers_count").alias("stars"))
    return counts.join(stars, ["window", "language"]).select(
        F.col("window.start").alias("window_start"),
        F.col("language").alias("Language"),
        ratio_or_zero(F.col("stars"), F.col("count")).alias("Average_Stars"),
    )


def running_divisible(numbers: DataFrame) -> DataFrame:
    return divisible_counts(numbers)


def distinct_rows(
    stream: DataFrame, keys: Sequence[str], lateness: tuple[str, str] | None = None
) -> DataFrame:
    """One row per key for the life of the query, kept in state as keys only.

    Of several rows of a key in the same micro-batch any may win; ``first_seen_updates`` and
    ``streaming.intake`` pick the earliest. ``lateness`` (time column, delay) bounds the state.
    """
    if lateness:
        return stream.withWatermark(*lateness).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def first_seen_updates(
    stream: DataFrame, key: str, arrival: str | Sequence[str], payload: Sequence[str], *more: Column
) -> DataFrame:
    """Per key the payload of its earliest row by ``arrival``, for update mode.

    Rows are stamped with the batch clock, which is one value per micro-batch and is logged, so
    that a repeated batch has it again. A key is new in this batch when its first and last stamp
    agree. State holds the payload: keep it to a few narrow columns. ``more`` are further aggregates
    over all rows of the key. Rows without a key or a language are left out.
    """
    order = [arrival] if isinstance(arrival, str) else arrival
    stamped = countable(stream, key).withColumn("stamp", F.current_timestamp())
    return stamped.groupBy(key).agg(
        F.min_by(F.struct(*payload), F.struct("stamp", *order)).alias("row"),
        (F.min("stamp") == F.max("stamp")).alias("is_new"),
        *more,
    )


def add_new_rows(path: str) -> BatchFunction:
    """Keep running count and star sum per language from the output of ``first_seen_updates``.

    Each batch adds its new keys to the snapshot of the batch before, which is one row per
    language. Works the same when a batch is repeated.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        totals = star_totals(batch.where("is_new").select("row.*"))
        if batch_id > 0:
            before = read_batch(batch.sparkSession, path, batch_id - 1, RUNNING_TOTALS)
            totals = add_totals(totals, before)
        write_batch(totals, path, batch_id)
        forget_batches(batch.sparkSession, path, batch_id - SNAPSHOTS)

    return add


def keep_first_of_numbers(path: str, number: str, arrival: str) -> BatchFunction:
    """Write the first row of each number ever seen, with the numbers seen kept as bitmaps.

    ``path`` gets the tables ``rows``, all batches, and ``seen``, the last snapshots. A batch reads the
    snapshot of the batch before it, so one that is repeated writes the same.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = (
            read_batch(spark, f"{path}/seen", batch_id - 1, seen.BITMAPS)
            if batch_id > 0
            else spark.createDataFrame([], seen.BITMAPS)
        )
        write_batch(seen.first_of_new(batch, number, arrival, before), f"{path}/rows", batch_id)
        write_batch(seen.merged(seen.bitmaps(batch, number), before), f"{path}/seen", batch_id)
        forget_batches(spark, f"{path}/seen", batch_id - SNAPSHOTS)

    return take


def keep_top_words(path: str, n: int = TOP_WORDS) -> BatchFunction:
    """Keep the top words per language from running word counts in update mode.

    Counts only grow, so a word of the new top list is either among the top of the words changed
    in this batch or was on the list before. Merging these two short lists gives the exact list
    without ranking or shuffling the whole vocabulary again. The old entry of a changed word can
    stay in: the words that keep its new count off the list are ahead of its old count too.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        top = ranked_words(batch.select("language", "word", "freq"), n)
        if batch_id > 0:
            before = read_batch(batch.sparkSession, path, batch_id - 1, RANKED)
            merged = top.unionByName(before).groupBy("language", "word")
            top = ranked_words(merged.agg(F.max("freq").alias("freq")), n)
        write_batch(top, path, batch_id)
        forget_batches(batch.sparkSession, path, batch_id - SNAPSHOTS)

    return rank


def fold(
    stream: DataFrame,
    key: str,
    value: str,
    lift: Callable[[int], int],
    merge: Callable[[int, int], int],
) -> DataFrame:
    """A user-defined running value per key: each value is lifted, then all are merged.

    ``merge`` must give the same whatever the order and grouping, as a task merges the rows of a key
    before the shuffle and sends one value for it; the key's state takes those in one by one.
    ``key`` is text, ``value`` an integer; rows where one is null are left out.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged: dict[str, int] = {}
        for frame in frames:
            for name, number in zip(frame["key"], frame["value"].tolist()):
                lifted = lift(number)
                merged[name] = merge(merged[name], lifted) if name in merged else lifted
        # A task without rows sends none: the columns of a frame without rows have no type.
        if merged:
            yield pd.DataFrame({"key": list(merged), "value": list(merged.values())})

    def step(
        group: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else None
        for frame in frames:
            for number in frame["value"].tolist():
                total = number if total is None else merge(total, number)
        state.update((total,))
        yield pd.DataFrame({"key": [group[0]], "value": [total]})

    pairs = stream.select(
        F.col(key).cast("string").alias("key"), F.col(value).cast("bigint").alias("value")
    ).where("key IS NOT NULL AND value IS NOT NULL")
    return (
        pairs.mapInPandas(partial, "key STRING, value BIGINT")
        .groupBy("key")
        .applyInPandasWithState(
            step,
            outputStructType="key STRING, value BIGINT",
            stateStructType="value BIGINT",
            outputMode="update",
            timeoutConf=GroupStateTimeout.NoTimeout,
        )
    )
