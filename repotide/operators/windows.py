"""Overlapping windows without a copy of a row for each window it lies in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.times import batch_start

DAY_SECONDS = 86_400


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} SECONDS")


def check_panes(size: int, slide: int) -> None:
    if slide <= 0 or size % slide:
        raise ValueError("a window must be a whole number of slides")


def sliding_counts(
    rows: DataFrame,
    time: str,
    keys: Sequence[str],
    size: int,
    slide: int,
    block: int = DAY_SECONDS,
) -> DataFrame:
    """(window_start, *keys, count): rows per key in windows of ``size`` seconds, one every ``slide``.

    Windows without a row of the key are left out, rows without a time count nowhere.

    Rows are counted once, in panes of one slide. A pane enters the windows at the start that is a size
    less a slide before it, and leaves them, by the inverse, at the start after it. Counts are running sums
    of these changes, so a window costs one addition however many panes it spans. The sums run
    within blocks of ``block`` seconds, to which the total of the blocks before is added, so a key with
    most of the rows, or all, is spread over as many tasks as there are blocks.
    """
    check_panes(size, slide)
    check_panes(block, slide)
    pane = batch_start(F.col(time), slide).alias("pane")
    panes = rows.where(F.col(time).isNotNull()).groupBy(*keys, pane).agg(F.count("*").alias("n"))
    change = F.explode(
        F.array(
            F.struct((F.col("pane") - _seconds(size - slide)).alias("at"), F.col("n").alias("by")),
            F.struct((F.col("pane") + _seconds(slide)).alias("at"), (-F.col("n")).alias("by")),
        )
    )
    changes = panes.select(*keys, change.alias("change")).select(*keys, "change.*")
    changes = changes.withColumn("block", batch_start(F.col("at"), block))
    inside = Window.partitionBy(*keys, "block").orderBy("at")
    runs = changes.withColumns({"sum": F.sum("by").over(inside), "until": F.lead("at").over(inside)})
    # One row for each block that a key has changes in.
    blocks = changes.groupBy(*keys, "block").agg(F.sum("by").alias("total"), F.min("at").alias("first"))
    by_key = Window.partitionBy(*keys).orderBy("block")
    before = F.sum("total").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(
        *(F.col(key).alias(f"_{key}") for key in keys),
        F.col("block").alias("_block"),
        F.coalesce(before, F.lit(0)).alias("before"),
        F.lead("first").over(by_key).alias("following"),
    )
    same = F.col("block") == F.col("_block")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    until = F.coalesce("until", "following")
    stretches = runs.join(blocks, same).select(
        *keys, "at", until.alias("until"), (F.col("sum") + F.col("before")).alias("count")
    )
    # What enters at the start at which something else leaves makes a stretch of no length.
    stretches = stretches.where((F.col("count") > 0) & (F.col("at") < F.col("until")))
    starts = F.sequence("at", F.col("until") - _seconds(slide), _seconds(slide))
    return stretches.select(F.explode(starts).alias("window_start"), *keys, "count")
