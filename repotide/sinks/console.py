"""Labelled printing of batch results."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame

from repotide.fixed import PREVIEW_ROWS

NOTHING = "(no rows in this batch)"


def show_batch(label: str, batch_time: datetime, rows: DataFrame) -> None:
    """Print all rows of a result that is a row per language, or few by its making otherwise."""
    when = f"batch {batch_time:%Y-%m-%d %H:%M:%S} | epoch {batch_time.timestamp():.0f}"
    print(f"== {label} | {when} ==")
    n = rows.count()
    if n:
        rows.show(n, truncate=False)
    else:
        print(NOTHING)


def preview(rows_shown: int = PREVIEW_ROWS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that prints the first rows of each batch."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"== batch {batch_id} ==")
        batch.show(rows_shown, truncate=False)

    return show
