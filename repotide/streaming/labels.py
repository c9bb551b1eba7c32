"""The two smaller stream programs: divisible numbers, and bucketed tab-separated repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repotide.fixed import (
    BATCH_SECONDS,
    NUMBER_BATCH_SECONDS,
    NUMBER_LATENESS,
    NUMBER_WINDOW_SECONDS,
)
from repotide.functions.labels import language_bucket
from repotide.functions.numbers import divisible_label
from repotide.operators.metrics import age_counts
from repotide.sinks.console import preview
from repotide.sinks.tables import view
from repotide.streaming.queries import BatchFunction, start, to_table
from repotide.streaming.boundaries import CLOCK, at_boundaries
from repotide.streaming.state import SNAPSHOTS, running_counts, running_divisible, windowed_counts


# Batches of a log that stay, unless told otherwise.
LOGGED = 1000


def with_arrival(rows: DataFrame) -> DataFrame:
    """Rows with the clock of the micro-batch they came in, as the column ``ts``."""
    return rows.withColumn("ts", F.current_timestamp())


def _both(*functions: BatchFunction) -> BatchFunction:
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for function in functions:
                function(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def _by_count(batch: DataFrame) -> DataFrame:
    with view(batch) as name:
        return batch.sparkSession.sql(f"SELECT isMultipleOf9, count FROM {name} ORDER BY count")


def start_number_analytics(
    numbers: DataFrame,
    out: str,
    checkpoint: str,
    every_seconds: int | None = NUMBER_BATCH_SECONDS,
    window_seconds: int = NUMBER_WINDOW_SECONDS,
    lateness: str = NUMBER_LATENESS,
    keep: int = LOGGED,
    steady: bool = False,
) -> list[StreamingQuery]:
    """Running totals of divisible and other numbers, and the same per window.

    Input columns: ``value`` and ``ts``. Totals go to ``running``, windows to ``windows``; both are
    also printed. A window is written once, when it can get no more rows: numbers may come
    ``lateness`` behind the newest, after which the window's state is dropped. The last few
    snapshots of the totals stay, and the windows of the last ``keep`` batches. ``steady`` adds the table
    ``steady``: the totals at every interval by the clock, also where no number came.
    """
    label = divisible_label(F.col("value")).alias("isMultipleOf9")
    labelled = numbers.select(F.col("ts").cast("timestamp").alias("ts"), label)
    windows = windowed_counts(
        labelled, "ts", "isMultipleOf9", size=window_seconds, lateness=lateness
    )
    more = []
    if steady:
        totals = at_boundaries(
            labelled, "ts", ["isMultipleOf9"], every_seconds or NUMBER_BATCH_SECONDS, mode=CLOCK
        )
        write = to_table(f"{out}/steady", keep=keep)
        more = [start(totals, write, f"{checkpoint}/steady", "update", every_seconds)]
    return more + [
        start(
            running_divisible(numbers),
            _both(
                lambda batch, batch_id: preview()(_by_count(batch), batch_id),
                to_table(f"{out}/running", _by_count, SNAPSHOTS),
            ),
            f"{checkpoint}/running",
            "complete",
            every_seconds,
        ),
        start(
            windows.select(F.col("window.start").alias("start"), "isMultipleOf9", "count"),
            _both(preview(), to_table(f"{out}/windows", keep=keep)),
            f"{checkpoint}/windows",
            "append",
            every_seconds,
        ),
    ]


def start_bucket_analytics(
    repos: DataFrame,
    out: str,
    checkpoint: str,
    every_seconds: int | None = BATCH_SECONDS,
    keep: int = LOGGED,
) -> list[StreamingQuery]:
    """Running repositories per language bucket, and old and recent ones per batch.

    Input columns: ``language`` and ``pushed_at``. Totals go to ``buckets``, of which the last few
    snapshots stay, ages to ``ages``, of which the last ``keep`` batches do.
    """
    bucket = language_bucket(F.col("language")).alias("lang")

    def ages(batch: DataFrame) -> DataFrame:
        return age_counts(batch, [], F.col("ts"))

    return [
        start(
            running_counts(repos, bucket),
            _both(preview(), to_table(f"{out}/buckets", keep=SNAPSHOTS)),
            f"{checkpoint}/buckets",
            "complete",
            every_seconds,
        ),
        start(
            with_arrival(repos),
            _both(
                lambda batch, batch_id: preview()(ages(batch), batch_id),
                to_table(f"{out}/ages", ages, keep),
            ),
            f"{checkpoint}/ages",
            "append",
            every_seconds,
        ),
    ]
