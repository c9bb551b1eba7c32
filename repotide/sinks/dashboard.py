"""Data of the dashboard panels: three numbers, a line per language, bars and word lists.

With ``others`` a panel shows every language that its rows have beside the tracked ones, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.fixed import HISTORY_LENGTH, TRACKED
from repotide.functions.times import clock_text
from repotide.operators.metrics import zero_fill
from repotide.operators.ranking import first_rows


def _untracked(rows: DataFrame, languages: Sequence[str]) -> DataFrame:
    return rows.where(~F.col("language").isin(*languages))


def _filled(rows: DataFrame, value: str, languages: Sequence[str], others: bool) -> DataFrame:
    filled = zero_fill(rows, value, languages).select("language", value)
    return filled.union(_untracked(rows, languages).select("language", value)) if others else filled


def totals_panel(counts: DataFrame, languages: Sequence[str] = TRACKED, others: bool = False) -> DataFrame:
    """Total per tracked language, zero when it has not been seen."""
    return _filled(counts, "count", languages, others).select(F.col("language").alias("lang"), "count")


def stars_panel(averages: DataFrame, languages: Sequence[str] = TRACKED, others: bool = False) -> DataFrame:
    """Average per tracked language, zero when it has not been seen."""
    rows = averages.select(F.col("Language").alias("language"), "Average_Stars")
    return _filled(rows, "Average_Stars", languages, others).select(
        F.col("language").alias("Language"), "Average_Stars"
    )


def recents_panel(
    recents: DataFrame,
    languages: Sequence[str] = TRACKED,
    n: int = HISTORY_LENGTH,
    others: bool = False,
) -> DataFrame:
    """The last ``n`` batches as one point per tracked language, oldest first in time.

    Input rows are ``(batch_time, language, recents)``. Each batch becomes one row with a column
    per tracked language, which fills the gaps without a join; the rows are unfolded only after
    the cut to ``n`` batches.
    """
    points = [
        F.sum(F.when(F.col("language") == name, F.col("recents")).otherwise(0)).alias(f"p{i}")
        for i, name in enumerate(languages)
    ]
    batches = recents.groupBy("batch_time").agg(*points)
    last = first_rows(batches, n, F.desc("batch_time"))
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("Language"), F.col(f"p{i}").alias("Recents"))
            for i, name in enumerate(languages)
        )
    )
    shown = last.select("batch_time", F.explode(entries).alias("e")).select("batch_time", "e.*")
    if others:
        own = _untracked(recents, languages).groupBy("language", "batch_time")
        own = own.agg(F.sum("recents").alias("Recents"))
        # Every other language with each of the last batches, whose times are one short row.
        times = last.agg(F.collect_list("batch_time").alias("times"))
        grid = own.select("language").distinct().crossJoin(F.broadcast(times))
        grid = grid.select("language", F.explode("times").alias("batch_time"))
        points = grid.join(own, ["language", "batch_time"], "left")
        shown = shown.union(points.select("batch_time", "language", F.coalesce("Recents", F.lit(0))))
    label = clock_text(F.col("batch_time")).alias("label")
    return shown.select("batch_time", label, "Language", "Recents")
