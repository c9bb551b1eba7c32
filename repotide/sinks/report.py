"""The text report of a finished run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.fixed import TRACKED
from repotide.functions.numbers import ratio_or_zero
from repotide.operators.metrics import tracked_lookup


def run_report(
    window: DataFrame, totals: DataFrame, lists: DataFrame, languages: Sequence[str] = TRACKED
) -> DataFrame:
    """The report as ``(line_no, line)``.

    ``window`` is one row of ``started`` and ``ended`` epoch seconds, ``totals`` holds ``count``
    and ``stars`` per language, ``lists`` the word lists. First the run window, then
    ``language:count:average``, then ``language:(word,n),...``, in the order of ``languages``.
    """
    first = window.select(
        F.lit(1).alias("line_no"), F.concat_ws(":", "started", "ended").alias("line")
    )

    count = F.coalesce("count", F.lit(0))
    average = ratio_or_zero(F.col("stars"), F.col("count"))
    numbers = tracked_lookup(totals, ["count", "stars"], languages).select(
        (F.col("position") + 2).alias("line_no"),
        F.concat_ws(":", "language", count.cast("string"), average.cast("string")).alias("line"),
    )
    words = tracked_lookup(lists, ["words"], languages).select(
        (F.col("position") + 2 + len(languages)).alias("line_no"),
        F.concat_ws(":", "language", F.coalesce("words", F.lit(""))).alias("line"),
    )
    return first.unionByName(numbers).unionByName(words)


def write_report(report: DataFrame, path: str) -> None:
    """The lines in order as one text file; there are two per language and one more."""
    report.orderBy("line_no").select("line").coalesce(1).write.text(path)
