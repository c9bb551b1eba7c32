"""Streaming queries: each replays a table through a streaming query and reads what it wrote."""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.times import batch_end
from repotide.operators import filters, metrics, ranking
from repotide.operators.dedup import latest_page, newest_pushes
from repotide.plans.batch import BATCH_SECONDS, DAY_SECONDS
from repotide.plans.tables import (
    BATCHES,
    TRACKED,
    edges_of,
    numbers,
    pushes,
    replayed,
    repos,
    table,
)
from repotide.session import run_dir
from repotide.sinks.tables import latest_batch, publish_once, read_batches
from repotide.sources.files import stream_table, union_streams
from repotide.sources.polls import stream_polls
from repotide.streaming import sketch, state
from repotide.streaming.app import BATCH_TIME, shown_panels, start_repo_analytics
from repotide.streaming.boundaries import at_boundaries
from repotide.streaming.intake import accepted_rows, intake_table, start_intake
from repotide.streaming.queries import BatchFunction, finish, read_state, start, to_table


def _replay(stream: DataFrame, on_batch: BatchFunction, root: str, mode: str = "update") -> None:
    finish(start(stream, on_batch, f"{root}/checkpoint", mode))


def _running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "totals")
    once = state.first_seen_updates(
        repos(spark, sf_dir, streaming=True).drop("description"),
        "id",
        "seq",
        ["language", "stargazers_count"],
    )
    _replay(once, state.add_new_rows(f"{root}/out"), root)
    return latest_batch(spark, f"{root}/out", state.RUNNING_TOTALS)


def stream_repo_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_totals(spark, sf_dir).select(F.col("language").alias("lang"), "count")


def stream_avg_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_stars(_running_totals(spark, sf_dir))


def stream_top10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "words")
    counts = metrics.word_counts(repos(spark, sf_dir, streaming=True))
    _replay(counts, state.keep_top_words(f"{root}/out"), root)
    top = latest_batch(spark, f"{root}/out", state.RANKED)
    return ranking.as_shown(top)


def stream_top10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same list with a sketch in place of the vocabulary, and exact counts of its candidates."""
    root = run_dir(spark, "sketch")
    _replay(repos(spark, sf_dir, streaming=True), sketch.keep_candidates(f"{root}/out"), root, "append")
    top, _ = sketch.top_words_of(repos(spark, sf_dir), f"{root}/out")
    return ranking.as_shown(top)


def _taken_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "intake")
    # Of copies in one batch, those without a number are the last, as in the batch form.
    arrival = F.coalesce("seq", F.lit(2**63 - 1))
    rows = repos(spark, sf_dir, streaming=True).drop("description").withColumn("arrival", arrival)
    for query in start_intake(rows, "id", "arrival", f"{root}/out", f"{root}/checkpoint"):
        finish(query)
    schema = "seq BIGINT, id BINARY, language STRING, stargazers_count BIGINT"
    return intake_table(spark, f"{root}/out", schema, "id")


def stream_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted_rows(_taken_in(spark, sf_dir))
    return rows.select(F.col("seq").alias("doc_id"), "language", "stargazers_count")


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _taken_in(spark, sf_dir).where("not accepted")
    return rows.select(F.col("seq").alias("doc_id"), "language", "reason")


def stream_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch writes the newest push per repository and batch it holds.

    Reading takes the newest of those, so a batch may be spread over any number of micro-batches
    and no state is kept.
    """
    root = run_dir(spark, "recent")
    rows = pushes(spark, sf_dir, streaming=True).withColumn(
        "batch_time", batch_end(F.col("pushed_at"), BATCH_SECONDS)
    )
    newest = to_table(f"{root}/out", lambda batch: newest_pushes(batch, ["batch_time"]))
    _replay(rows, newest, root, "append")
    written = read_batches(
        spark,
        f"{root}/out",
        "batch_time TIMESTAMP_NTZ, language STRING, id BIGINT, pushed_at TIMESTAMP_NTZ",
    )
    counts = metrics.recent_counts(written, ["batch_time"], F.col("batch_time"))
    return counts.select(
        "batch_time", F.col("language").alias("Language"), F.col("recents").alias("Recents")
    )


def stream_nine_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "running")
    counts = state.running_divisible(numbers(spark, sf_dir, streaming=True))
    _replay(counts, to_table(f"{root}/out"), root, "complete")
    return latest_batch(spark, f"{root}/out", "isMultipleOf9 STRING, count BIGINT")


def stream_nine_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "tumbling")
    rows = numbers(spark, sf_dir, streaming=True).select(
        "ts", metrics.divisible_label(F.col("value")).alias("isMultipleOf9")
    )
    counts = state.windowed_counts(rows, "ts", "isMultipleOf9").select(
        F.col("window.start").alias("window_start"), "isMultipleOf9", "count"
    )
    _replay(counts, to_table(f"{root}/out"), root)
    written = read_batches(
        spark, f"{root}/out", "window_start TIMESTAMP_NTZ, isMultipleOf9 STRING, count BIGINT"
    )
    return ranking.newest_by_key(written, ["window_start", "isMultipleOf9"], "batch_id")


START = 1_704_067_200


def stream_avg_stars_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average stars by language of every hundred seconds of pushes, a second apart, that have passed."""
    root = run_dir(spark, "joined")
    rows = repos(spark, sf_dir, streaming=True).select(
        "language", "stargazers_count", F.timestamp_seconds(START + F.col("seq")).alias("pushed_at")
    )
    averages = state.joined_averages(rows, "pushed_at", 100, "10 seconds")
    _replay(averages, to_table(f"{root}/out"), root, "append")
    written = read_batches(
        spark, f"{root}/out", "window_start TIMESTAMP, Language STRING, Average_Stars DOUBLE"
    )
    start_time = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return written.select(start_time, "Language", "Average_Stars")


def stream_union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per language and hundred seconds from a feed for each language, one of which is slow.

    The feeds' watermarks advance on their own, and windows close when the slowest feed has passed.
    """
    root = run_dir(spark, "feeds")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    # As many feeds as there are languages.
    names = sorted(row["lang"] or "" for row in documents.select("lang").distinct().collect())
    feeds = []
    for i, name in enumerate(names):
        own = documents.where(F.coalesce("lang", F.lit("")) == name)
        feed = replayed(own, f"feed-{i}", "doc_id", 2 * BATCHES if i == 0 else BATCHES, "doc_id BIGINT, lang STRING")
        feeds.append(feed.withColumn("ts", F.timestamp_seconds(START + F.col("doc_id"))))
    rows = union_streams(feeds, "ts", ["0 seconds"] * len(feeds))
    counts = metrics.count_by(rows, F.window("ts", "100 seconds"), "lang")
    counts = counts.select(F.col("window.start").alias("window_start"), "lang", "count")
    _replay(counts, to_table(f"{root}/out"), root, "append")
    written = read_batches(spark, f"{root}/out", "window_start TIMESTAMP, lang STRING, count BIGINT")
    start_time = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return written.select(start_time, F.col("lang").alias("language"), "count")


def stream_poll_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's pushes as a poll round; rounds come in while the query is stopped, and it goes on."""
    root = run_dir(spark, "polls")
    rows = filters.in_polls(pushes(spark, sf_dir), "pushed_at", DAY_SECONDS)
    columns = ["seq", "id", "language", "pushed_at", "poll"]
    day = F.datediff(F.col("poll").cast("date"), F.lit("1970-01-01").cast("date"))
    rows = rows.select(*columns, day.alias("day"))
    schema = "seq BIGINT, id BIGINT, language STRING, pushed_at TIMESTAMP_NTZ, poll TIMESTAMP_NTZ"
    pages = to_table(f"{root}/out", lambda batch: latest_page(batch, "poll"))
    for low, high in pairwise(edges_of(rows, "day", 3)):
        for number in range(low, high):
            publish_once(rows.where(F.col("day") == number).select(*columns), f"{root}/in", number)
        _replay(stream_polls(spark, f"{root}/in", schema), pages, root, "append")
    page = "poll TIMESTAMP_NTZ, language STRING, id BIGINT, pushed_at TIMESTAMP_NTZ, rank INT"
    return read_batches(spark, f"{root}/out", page).drop("batch_id")


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divisible and other numbers in the hour before every tenth minute that the stream has passed."""
    root = run_dir(spark, "sliding")
    rows = numbers(spark, sf_dir, streaming=True).select(
        "ts", metrics.divisible_label(F.col("value")).alias("isMultipleOf9")
    )
    _replay(at_boundaries(rows, "ts", ["isMultipleOf9"], 600, 3600), to_table(f"{root}/out"), root)
    schema = "isMultipleOf9 STRING, boundary TIMESTAMP, count BIGINT"
    return read_batches(spark, f"{root}/out", schema).select(
        F.col("boundary").cast("timestamp_ntz").alias("window_end"), "isMultipleOf9", "count"
    )


def stream_every_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pushes so far by language at every sixth hour that the stream has passed, new ones or not."""
    root = run_dir(spark, "boundaries")
    counts = at_boundaries(pushes(spark, sf_dir, streaming=True), "pushed_at", ["language"], 21_600)
    _replay(counts, to_table(f"{root}/out"), root)
    written = read_batches(spark, f"{root}/out", "language STRING, boundary TIMESTAMP, count BIGINT")
    return written.select(F.col("boundary").cast("timestamp_ntz").alias("boundary"), "language", "count")


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is in the state of a running count that was stopped half way and started again."""
    root = run_dir(spark, "state")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("value"))
    for low, high in pairwise(edges_of(rows, "event_id", 2)):
        part = rows.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.write.mode("append").parquet(f"{root}/in")
        stream = stream_table(spark, f"{root}/in", "event_id BIGINT, value BIGINT")
        labelled = stream.select(metrics.divisible_label(F.col("value")).alias("isMultipleOf9"))
        _replay(state.running_counts(labelled, "isMultipleOf9"), to_table(f"{root}/out"), root)
    return read_state(spark, f"{root}/checkpoint").select("key.isMultipleOf9", "value.count")


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals of a query that starts a batch every second, stopped when it has caught up."""
    root = run_dir(spark, "interval")
    counts = state.running_divisible(numbers(spark, sf_dir, streaming=True))
    query = start(counts, to_table(f"{root}/out"), f"{root}/checkpoint", "complete", every_seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return latest_batch(spark, f"{root}/out", "isMultipleOf9 STRING, count BIGINT")


def stream_first_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first push of each repository number, with the numbers seen kept as bitmaps."""
    root = run_dir(spark, "numbers")
    rows = pushes(spark, sf_dir, streaming=True).select("seq", "id", "language")
    _replay(rows, state.keep_first_of_numbers(f"{root}/out", "id", "seq"), root, "append")
    schema = "seq BIGINT, id BIGINT, language STRING"
    return read_batches(spark, f"{root}/out/rows", schema).drop("batch_id")


MODULUS = 1_000_003


def state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of a set of numbers, the same in any order: their product in modular arithmetic."""
    root = run_dir(spark, "fold")
    rows = pushes(spark, sf_dir, streaming=True)
    products = state.fold(
        rows, "language", "id", lambda v: v % MODULUS + 1, lambda a, b: a * b % MODULUS
    )
    _replay(products, to_table(f"{root}/out"), root)
    written = read_batches(spark, f"{root}/out", "key STRING, value BIGINT")
    newest = ranking.newest_by_key(written, ["key"], "batch_id")
    return newest.select(F.col("key").alias("event_type"), F.col("value").alias("fingerprint"))


def stream_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole application on one replay; its four panels, as published together, in one long table.

    Panels show every language of the documents, and zeros for tracked ones that have none.
    A batch of the replay is stamped with the end of the range of numbers it holds, as a stream
    would be with its clock, and every document with a push time by its number.
    """
    root = run_dir(spark, "app")
    seq = F.col("seq")
    rows = repos(spark, sf_dir, streaming=True).withColumns(
        {
            "pushed_at": F.timestamp_seconds(F.lit(1_704_067_200) + seq),
            BATCH_TIME: F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(seq / 100) * 100 + 99),
        }
    )
    out = f"{root}/out"
    checkpoint = f"{root}/checkpoint"
    for query in start_repo_analytics(rows, out, checkpoint, None, languages=TRACKED, others=True):
        finish(query)
    return reduce(DataFrame.unionByName, shown_panels(spark, out).values())


QUERIES = {
    "stream_repo_totals": stream_repo_totals,
    "stream_avg_stars": stream_avg_stars,
    "stream_top10_words": stream_top10_words,
    "stream_top10_sketch": stream_top10_sketch,
    "stream_accepted": stream_accepted,
    "stream_rejected": stream_rejected,
    "stream_recent": stream_recent,
    "stream_nine_running": stream_nine_running,
    "stream_nine_tumbling": stream_nine_tumbling,
    "stream_avg_stars_join": stream_avg_stars_join,
    "stream_union_feeds": stream_union_feeds,
    "stream_poll_rounds": stream_poll_rounds,
    "stream_state": stream_state,
    "stream_interval": stream_interval,
    "stream_first_numbers": stream_first_numbers,
    "stream_sliding_counts": stream_sliding_counts,
    "stream_every_boundary": stream_every_boundary,
    "state_fold": state_fold,
    "stream_dashboard": stream_dashboard,
}
