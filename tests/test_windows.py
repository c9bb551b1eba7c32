"""Sliding windows by differences, and counts at every boundary, against plain sums."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from repotide.operators.windows import sliding_counts
from repotide.sinks import tables
from repotide.streaming.boundaries import CLOCK, at_boundaries
from repotide.streaming.labels import _by_count, start_number_analytics
from repotide.streaming.queries import finish, start, to_table
from test_streams import arrive, in_two_runs, stream

NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
TIMED = "ts TIMESTAMP, k STRING"
OUT = "k STRING, boundary TIMESTAMP, count BIGINT"


def moments(n, seed=1, span=4000):
    rng = random.Random(seed)
    return [(NOON + timedelta(seconds=rng.randrange(span)), rng.choice(["a", "a", "b", None])) for _ in range(n)]


@pytest.mark.parametrize("size, slide, block", [(60, 5, 300), (60, 60, 120), (300, 20, 86_400), (90, 30, 30)])
def test_sliding_counts_equal_copies_of_rows(spark, size, slide, block):
    rows = spark.createDataFrame([*moments(150), (None, "a")], TIMED).repartition(3)
    found = sliding_counts(rows, "ts", ["k"], size, slide, block)
    window = F.window("ts", f"{size} seconds", f"{slide} seconds").start.alias("window_start")
    assert rows_of(found) == rows_of(rows.where("ts IS NOT NULL").groupBy(window, "k").agg(F.count("*").alias("count")))


def test_sliding_counts_without_keys_or_rows(spark):
    rows = spark.createDataFrame(moments(40), TIMED)
    window = F.window("ts", "50 seconds", "10 seconds").start.alias("window_start")
    assert rows_of(sliding_counts(rows, "ts", [], 50, 10)) == rows_of(rows.groupBy(window).agg(F.count("*").alias("count")))
    assert sliding_counts(rows.limit(0), "ts", ["k"], 50, 10).collect() == []
    with pytest.raises(ValueError):
        sliding_counts(rows, "ts", [], 50, 7)


def test_rows_are_not_copied_for_each_window(spark):
    rows = spark.createDataFrame(moments(40), TIMED)
    plan = plan_of(sliding_counts(rows, "ts", ["k"], 3600, 5))
    assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Rows are counted by pane before anything is shuffled.
    assert "partial_count" in plan[plan.rindex("Exchange hashpartitioning"):]


def plain(rows, slide, size, lateness=0):
    """What comes out once all rows are there, by summing over rows."""
    def end(ts):
        seconds = int(ts.timestamp())
        return seconds - seconds % slide + slide

    last = max(end(ts) for ts, _ in rows) - lateness
    out = []
    for key in {k for _, k in rows}:
        own = [end(ts) for ts, k in rows if k == key]
        for boundary in range(min(own), last, slide):
            n = sum(boundary - (size or 1 << 40) < e <= boundary for e in own)
            if n or not size:
                out.append((key, datetime.fromtimestamp(boundary, timezone.utc).replace(tzinfo=None), n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [None, 200, 50])
def test_boundaries_over_a_restart(spark, folder, size):
    rows = sorted(moments(120), key=lambda r: r[0])

    def run():
        found = at_boundaries(stream(spark, f"{folder}/in", TIMED), "ts", ["k"], 50, size)
        return start(found, to_table(f"{folder}/out"), f"{folder}/c")

    in_two_runs(spark, folder, rows, run, TIMED)
    written = tables.read_batches(spark, f"{folder}/out", OUT)
    assert rows_of(written.select("k", "boundary", "count")) == plain(rows, 50, size)
    assert written.select("batch_id").distinct().count() > 2


def test_rows_out_of_order_and_too_late(spark, folder):
    at = lambda s: NOON + timedelta(seconds=s)
    on_time = [(at(200), "a"), (at(40), "b"), (at(130), "a"), (at(90), "a"), (at(400), "b"), (at(310), "a")]
    late = [(at(20), "a")]
    arrive(spark, f"{folder}/in", [*on_time[:3], *on_time[3:], *late, (at(600), "b")], 8, TIMED)
    found = at_boundaries(stream(spark, f"{folder}/in", TIMED), "ts", ["k"], 50, lateness=150)
    finish(start(found, to_table(f"{folder}/out"), f"{folder}/c"))
    written = tables.read_batches(spark, f"{folder}/out", OUT).select("k", "boundary", "count")
    assert rows_of(written) == plain([*on_time, (at(600), "b")], 50, None, 150)


def test_a_key_comes_out_by_the_clock_without_new_rows(spark, folder):
    arrive(spark, f"{folder}/in", [(NOON, "a"), (NOON, "a"), (NOON, "b")], 1, TIMED)
    found = at_boundaries(stream(spark, f"{folder}/in", TIMED), "ts", ["k"], 1, mode=CLOCK)
    query = start(found, to_table(f"{folder}/out"), f"{folder}/c", every_seconds=1)
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            time.sleep(1)
            shown = tables.read_batches(spark, f"{folder}/out", OUT) if tables.batch_numbers(spark, f"{folder}/out") else None
            if shown is not None and shown.select("boundary").distinct().count() >= 4:
                break
    finally:
        query.stop()
    per_key = {}
    for row in shown.collect():
        per_key.setdefault(row["k"], []).append((row["boundary"], row["count"]))
    assert {k: {n for _, n in own} for k, own in per_key.items()} == {"a": {2}, "b": {1}}
    for own in per_key.values():
        times = sorted(t for t, _ in own)
        assert len(times) >= 3 and all(b - a == timedelta(seconds=1) for a, b in zip(times, times[1:]))


def test_views_and_folders_stay_level(spark, folder):
    counts = spark.createDataFrame([("Yes", 2), ("No", 1)], "isMultipleOf9 STRING, count BIGINT")
    before = len(spark.catalog.listTables())
    for batch_id in range(30):
        to_table(f"{folder}/t", _by_count, 10)(counts, batch_id)
    assert len(spark.catalog.listTables()) == before
    assert tables.batch_numbers(spark, f"{folder}/t") == list(range(19, 30))
    assert [r[0] for r in _by_count(counts).collect()] == ["No", "Yes"]


def test_number_program_forgets(spark, folder):
    rows = [(NOON + timedelta(seconds=30 * i), i) for i in range(26)]
    arrive(spark, f"{folder}/in", rows, 26, "ts TIMESTAMP, value BIGINT")
    source = stream(spark, f"{folder}/in", "ts TIMESTAMP, value BIGINT")
    for query in start_number_analytics(source, f"{folder}/out", f"{folder}/c", None, keep=5):
        finish(query)
    assert len(tables.batch_numbers(spark, f"{folder}/out/running")) == 11
    assert len(tables.batch_numbers(spark, f"{folder}/out/windows")) == 6
