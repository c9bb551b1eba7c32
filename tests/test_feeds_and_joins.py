"""Poll rounds with offsets, feeds of different pace, joined running aggregates."""

import os
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from conftest import rows_of
from repotide.sinks import tables
from repotide.sources import polls
from repotide.sources.files import union_streams
from repotide.sources.polls import PollReader, stream_polls
from repotide.streaming import state
from repotide.streaming.queries import finish, start, to_table
from test_streams import arrive, stream

NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
PUSHES = "id BIGINT, language STRING"


def at(seconds):
    return NOON + timedelta(seconds=seconds)


def polled(spark, folder):
    return start(stream_polls(spark, f"{folder}/in", PUSHES), to_table(f"{folder}/out"), f"{folder}/c", "append")


def publish(spark, folder, number, ids, parts=1):
    rows = spark.createDataFrame([(i, f"l{i % 3}") for i in ids], PUSHES).repartition(parts)
    tables.publish_once(rows, f"{folder}/in", number)


def seen(spark, folder):
    return tables.read_batches(spark, f"{folder}/out", f"{PUSHES}, round BIGINT")


def test_rounds_come_exactly_once_over_restarts(spark, folder):
    for number in (0, 1, 2):
        publish(spark, folder, number, range(number * 10, number * 10 + 12), parts=3)
    finish(polled(spark, folder))
    finish(polled(spark, folder))
    publish(spark, folder, 3, [7, 7, 99])
    publish(spark, folder, 5, [1])
    finish(polled(spark, folder))
    rows = [(i, f"l{i % 3}", n) for n in (0, 1, 2) for i in range(n * 10, n * 10 + 12)]
    rows += [(7, "l1", 3), (7, "l1", 3), (99, "l0", 3), (1, "l1", 5)]
    assert rows_of(seen(spark, folder), "id", "language", "round") == sorted(rows, key=repr)


def test_a_batch_that_failed_gets_the_same_rounds_again(spark, folder):
    publish(spark, folder, 0, range(5))

    def fail(batch, batch_id):
        batch.count()
        raise RuntimeError("lost")

    query = start(stream_polls(spark, f"{folder}/in", PUSHES), fail, f"{folder}/c", "append")
    try:
        finish(query)
    except Exception as error:
        assert "lost" in str(error)
    publish(spark, folder, 1, range(5, 8))
    # A run that begins with such a batch ends after it.
    finish(polled(spark, folder))
    finish(polled(spark, folder))
    assert rows_of(seen(spark, folder), "id", "round", "batch_id") == sorted(
        [(i, 0, 0) for i in range(5)] + [(i, 1, 1) for i in range(5, 8)], key=repr
    )


def test_rounds_and_offsets(spark, folder):
    reader = PollReader(f"{folder}/in", spark.range(1).schema)
    assert reader.latestOffset() == reader.initialOffset() == {"round": 0}
    publish(spark, folder, 4, range(6), parts=2)
    os.makedirs(f"{folder}/in/_staged-x")
    assert reader.latestOffset() == {"round": 5}
    assert PollReader(f"file://{folder}/in", spark.range(1).schema).latestOffset() == {"round": 5}
    assert len(reader.partitions({"round": 0}, {"round": 5})) == 2
    assert reader.partitions({"round": 0}, {"round": 4}) == reader.partitions({"round": 5}, {"round": 9}) == []


def test_a_round_is_published_once(spark, folder):
    publish(spark, folder, 0, [1])
    before = os.listdir(f"{folder}/in/batch_id=0")
    publish(spark, folder, 0, [1])
    assert os.listdir(f"{folder}/in/batch_id=0") == before and os.listdir(f"{folder}/in") == ["batch_id=0"]


TIMED = "ts TIMESTAMP, k STRING"


def counted_feeds(spark, folder, watermark):
    feeds = [stream(spark, f"{folder}/{name}", TIMED) for name in ("fast", "slow")]
    rows = union_streams(feeds, "ts", ["0 seconds", "5 seconds"])
    counts = rows.groupBy(F.window("ts", "10 seconds"), "k").agg(F.count("*").alias("n"))
    counts = counts.select(F.col("window.start").alias("start"), "k", "n")
    return start(counts, to_table(f"{folder}/{watermark}"), f"{folder}/c-{watermark}", "append", watermark=watermark)


def test_a_slow_feed_loses_no_row(spark, folder):
    fast = [(at(10 * i + 1), "fast") for i in range(12)]
    slow = [(at(10 * i + 2), "slow") for i in range(12)]
    arrive(spark, f"{folder}/fast", fast, 2, TIMED)
    arrive(spark, f"{folder}/slow", slow, 6, TIMED)
    finish(counted_feeds(spark, folder, "min"))
    found = tables.read_batches(spark, f"{folder}/min", "start TIMESTAMP, k STRING, n BIGINT")
    closed = [at(10 * i).replace(tzinfo=None) for i in range(10)]
    assert rows_of(found, "start", "k", "n") == sorted(((t, k, 1) for t in closed for k in ("fast", "slow")), key=repr)
    # Going by the fastest feed, most of the slow one comes too late.
    finish(counted_feeds(spark, folder, "max"))
    rushed = tables.read_batches(spark, f"{folder}/max", "start TIMESTAMP, k STRING, n BIGINT")
    assert rushed.where("k = 'slow'").count() < 8 and rushed.where("k = 'fast'").count() == 11


STARRED = "pushed_at TIMESTAMP, language STRING, stargazers_count BIGINT"


def test_joined_averages_drop_late_rows_on_both_sides(spark, folder):
    rows = [(at(1), "C", 4), (at(3), "C", 8), (at(5), "Go", 0), (at(7), None, 9), (at(22), "C", 1), (at(24), "C", None),
            (at(41), "Go", 5), (at(42), "Go", 5), (at(12), "C", 100), (at(2), "C", 1000), (at(75), "C", 3), (at(80), "Go", 1)]
    arrive(spark, f"{folder}/in", rows, 12, STARRED)
    averages = state.joined_averages(stream(spark, f"{folder}/in", STARRED), "pushed_at", 20, "10 seconds")
    query = start(averages, to_table(f"{folder}/out"), f"{folder}/c", "append")
    finish(query)
    found = tables.read_batches(spark, f"{folder}/out", "window_start TIMESTAMP, Language STRING, Average_Stars DOUBLE")
    day = lambda s: at(s).replace(tzinfo=None)
    # The rows at 12 and 2 came when their window had closed; the window at 60 is still open.
    assert rows_of(found, "window_start", "Language", "Average_Stars") == sorted(
        [(day(0), "C", 6.0), (day(0), "Go", 0.0), (day(20), "C", 0.5), (day(40), "Go", 5.0)], key=repr
    )
    operators = query.lastProgress["stateOperators"]
    assert len(operators) == 3 and all(o["numRowsTotal"] <= 4 for o in operators)


def test_joined_averages_over_a_restart(spark, folder):
    rows = [(at(i), "C" if i % 3 else "Go", i) for i in range(120)]

    def run():
        averages = state.joined_averages(stream(spark, f"{folder}/in", STARRED), "pushed_at", 20, "0 seconds")
        finish(start(averages, to_table(f"{folder}/out"), f"{folder}/c", "append"))

    arrive(spark, f"{folder}/in", rows[:50], 2, STARRED)
    run()
    arrive(spark, f"{folder}/in", rows[50:], 2, STARRED, first=2)
    run()
    found = tables.read_batches(spark, f"{folder}/out", "window_start TIMESTAMP, Language STRING, Average_Stars DOUBLE")
    window = F.window("pushed_at", "20 seconds").start.alias("w")
    same = spark.createDataFrame(rows[:100], STARRED).groupBy(window, "language").agg(F.avg("stargazers_count"))
    assert rows_of(found.drop("batch_id")) == rows_of(same)


def test_another_session_may_know_the_poll_source(spark, folder):
    stream_polls(spark, f"{folder}/in", PUSHES)
    other = spark.newSession()
    spark.createDataFrame([(1,)], "a INT")  # makes its session the active one
    for _ in range(2):
        assert stream_polls(other, f"{folder}/in", PUSHES).columns[-1] == "round"
    active = SparkSession._get_j_spark_session_class(spark._jvm).getActiveSession().get()
    assert active.equals(spark._jsparkSession)


def test_a_failed_lookup_of_the_poll_source_is_tried_again():
    class Failed(AnalysisException):
        def __init__(self, condition):
            super().__init__(message=condition)
            self.condition = condition

        def getCondition(self):
            return self.condition

    def session(failures, condition="DATA_SOURCE_ALREADY_EXISTS"):
        calls = []

        def register(source):
            calls.append(source)
            if len(calls) <= failures:
                raise Failed(condition)

        return SimpleNamespace(dataSource=SimpleNamespace(register=register)), calls

    once, calls = session(1)
    polls._register(once)
    assert len(calls) == 2
    for always, tries in ((session(9), 3), (session(9, "DATA_SOURCE_NOT_FOUND"), 1)):
        with pytest.raises(AnalysisException):
            polls._register(always[0])
        assert len(always[1]) == tries
