"""Time expressions. Every instant is UTC; ``now`` is always passed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repotide.fixed import CLOCK_FORMAT, OLD, PUSHED_AT_FORMAT, RECENT, RECENT_SECONDS


def parse_utc(text: Column) -> Column:
    """An instant from ``2024-01-31T10:00:00Z``, null where the text is not one.

    No pattern: a quoted Z in a pattern would be read in the session time zone.
    """
    return F.try_to_timestamp(text)


def utc_text(instant: Column) -> Column:
    return F.date_format(instant, PUSHED_AT_FORMAT)


def clock_text(instant: Column) -> Column:
    return F.date_format(instant, CLOCK_FORMAT)


def epoch_seconds(instant: Column) -> Column:
    return F.unix_timestamp(instant)


def is_recent(pushed_at: Column, now: Column, seconds: int = RECENT_SECONDS) -> Column:
    """Pushed at most ``seconds`` ago; a push ahead of the clock counts as recent."""
    return pushed_at >= now - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def age_label(pushed_at: Column, now: Column, seconds: int = RECENT_SECONDS) -> Column:
    """``old`` from exactly ``seconds`` on, ``recent`` below that."""
    return F.when(
        pushed_at <= now - F.expr(f"INTERVAL {int(seconds)} SECONDS"), OLD
    ).otherwise(RECENT)


def batch_end(instant: Column, seconds: int) -> Column:
    """End of the fixed-length batch an instant falls into."""
    return F.window(instant, f"{int(seconds)} seconds")["end"]


def batch_start(instant: Column, seconds: int) -> Column:
    return F.window(instant, f"{int(seconds)} seconds")["start"]
