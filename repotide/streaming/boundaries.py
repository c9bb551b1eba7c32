"""Counts that come out at every boundary of a calendar, whether or not there was new data.

State holds, per key, the counts of panes that end at a boundary to come and the total so far, and a
timer for the next boundary. When it fires, the pane that ends there is added to the total and, if
windows have a size, the pane that leaves them is taken away again: an inverse instead of a new sum
over the window. A boundary fires when the watermark passes it, or by the clock.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from repotide.operators.windows import check_panes

EVENT_TIME, CLOCK = "EventTime", "ProcessingTime"


class Boundaries(StatefulProcessor):
    """Running or sliding counts of one key; times are epoch milliseconds."""

    def __init__(self, slide: int, size: int | None, mode: str) -> None:
        self.slide, self.size, self.mode = slide, size, mode

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "total BIGINT, next BIGINT")
        self.panes = handle.getMapState("panes", "pane_end BIGINT", "n BIGINT")

    def _now(self, timers: TimerValues) -> int:
        if self.mode == CLOCK:
            return timers.getCurrentProcessingTimeInMs()
        return timers.getCurrentWatermarkInMs()

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        ends: dict[int, int] = {}
        for frame in rows:
            for end, n in zip(frame["pane_end"].tolist(), frame["n"].tolist()):
                if self.mode == CLOCK:
                    end = (self._now(timerValues) // self.slide + 1) * self.slide
                ends[end] = ends.get(end, 0) + n
        for end, n in ends.items():
            held = self.panes.getValue((end,)) if self.panes.containsKey((end,)) else (0,)
            self.panes.updateValue((end,), (held[0] + n,))
        if ends:
            total, following = self.totals.get() if self.totals.exists() else (0, None)
            # Rows of a key may come out of order as long as their boundary has not passed.
            first = min(ends)
            if following is None or first < following:
                if following is not None:
                    self.handle.deleteTimer(following)
                self._wait(total, first)
        return iter(())

    def _wait(self, total: int, boundary: int) -> None:
        self.totals.update((total, boundary))
        self.handle.registerTimer(boundary)

    def _taken(self, end: int) -> int:
        return self.panes.getValue((end,))[0] if self.panes.containsKey((end,)) else 0

    def _following(self, total: int, boundary: int) -> int | None:
        """The next boundary at which there is something to say."""
        if self.size is None or total:
            return boundary + self.slide
        return min((end for (end,) in self.panes.keys()), default=None)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        total, boundary = self.totals.get()
        out: list[tuple] = []
        # One step of the watermark may pass many boundaries.
        while boundary is not None and boundary <= self._now(timerValues):
            total += self._taken(boundary)
            if self.size is None:
                self.panes.removeKey((boundary,))
            else:
                total -= self._taken(boundary - self.size)
                self.panes.removeKey((boundary - self.size,))
            if self.size is None or total:
                out.append((*key, boundary, total))
            boundary = self._following(total, boundary)
        if boundary is None:
            self.totals.clear()
        else:
            self._wait(total, boundary)
        if out:
            yield pd.DataFrame(out)


def _in_panes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task counted by key and pane, so that a hot key sends a row per pane and batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        counted = table.group_by(batch.schema.names).aggregate([([], "count_all")])
        yield from counted.rename_columns([*batch.schema.names, "n"]).combine_chunks().to_batches()


def at_boundaries(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    slide: int,
    size: int | None = None,
    lateness: int = 0,
    mode: str = EVENT_TIME,
) -> DataFrame:
    """(*keys, boundary, count): what each key counts at every boundary, ``slide`` seconds apart.

    Without ``size`` the count runs from the start, and from its first boundary on each key comes out at
    all of them, with the count it had if nothing was new. With it, the count is of the ``size`` seconds
    before the boundary; windows without a row are left out.

    In event time a boundary comes out once the newest row's slide starts more than ``lateness``
    (whole slides) after it; rows of slides that came out are too late. By the clock a row counts at
    the next boundary, and boundaries come out as time goes by. ``keys`` are text; rows without a time
    are left out. Run in update mode.
    """
    check_panes(size or slide, slide)
    check_panes(lateness or slide, slide)
    end = F.window(time, f"{slide} seconds")["end"].cast("timestamp")
    rows = stream.where(F.col(time).isNotNull()).select(
        *(F.col(key).cast("string").alias(key) for key in keys), F.unix_millis(end).alias("pane_end")
    )
    names = ", ".join(f"{key} STRING" for key in keys)
    counted = rows.mapInArrow(_in_panes, f"{names}, pane_end BIGINT, n BIGINT")
    if mode == EVENT_TIME:
        # A row's time is the last moment of its slide, so whether it is late does not depend on others.
        # Rows at the watermark itself are too late; it stays a moment behind the newest slide.
        moment = F.timestamp_millis(F.col("pane_end") - 1)
        delay = f"{lateness} seconds 1 millisecond"
        counted = counted.withColumn("moment", moment).withWatermark("moment", delay)
    found = counted.groupBy(*keys).transformWithStateInPandas(
        Boundaries(slide * 1000, size * 1000 if size else None, mode),
        outputStructType=f"{names}, boundary BIGINT, count BIGINT",
        outputMode="Update",
        timeMode=mode,
    )
    return found.select(*keys, F.timestamp_millis("boundary").alias("boundary"), "count")
