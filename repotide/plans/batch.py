"""Batch queries over the given tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.labels import language_bucket
from repotide.functions.times import batch_end, batch_start
from repotide.operators import dedup, filters, metrics, ranking
from repotide.operators.windows import sliding_counts
from repotide.plans.tables import (
    TRACKED,
    TRACKED_TYPES,
    ab_table,
    numbers,
    pushes,
    repos,
    table,
)
from repotide.session import run_dir
from repotide.sinks import dashboard
from repotide.sinks.report import run_report as report_lines
from repotide.sinks.tables import as_columns, view, write_csv
from repotide.sources.files import read_csv, union_feeds

BATCH_SECONDS = 300
DAY_SECONDS = 86_400


def batched(rows: DataFrame, seconds: int = BATCH_SECONDS) -> DataFrame:
    """Pushes with the end of the batch they fall into."""
    return rows.withColumn("batch_time", batch_end(F.col("pushed_at"), seconds))


def recents(rows: DataFrame) -> DataFrame:
    return metrics.recent_counts(batched(rows), ["batch_time"], F.col("batch_time"))


def distinct_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories once each, without their texts."""
    narrow = repos(spark, sf_dir).drop("description")
    return dedup.first_seen(filters.countable(narrow), ["id"], "seq")


# Words ------------------------------------------------------------------------------------


def top10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(metrics.word_counts(repos(spark, sf_dir)))


def top10_words_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(metrics.word_counts(repos(spark, sf_dir), fold_case=True))


def top10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_words(metrics.word_counts(repos(spark, sf_dir), keep_empty=True))


def top10_words_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.countable(repos(spark, sf_dir))
    return ranking.top_words(metrics.word_counts(dedup.first_seen_wide(rows, ["id"], "seq")))


def word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ranking.word_lists(ranking.ranked_words(metrics.word_counts(repos(spark, sf_dir))))
    return lists.select(F.col("language").alias("Language"), "words")


def columns_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = as_columns(repo_totals(spark, sf_dir), "lang")
    return columns.select(*(F.concat_ws(",", name).alias(name) for name in columns.columns))


# Totals, stars, duplicates ------------------------------------------------------------------


def repo_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = metrics.repo_totals(distinct_repos(spark, sf_dir))
    return totals.select(F.col("language").alias("lang"), "count")


def avg_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_stars(metrics.star_totals(distinct_repos(spark, sf_dir)))


def avg_stars_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = distinct_repos(spark, sf_dir)
    stars = once.groupBy("language").agg(F.sum("stargazers_count").alias("stars"))
    return metrics.average_stars_joined(metrics.repo_totals(once), stars)


def totals_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = metrics.repo_totals(distinct_repos(spark, sf_dir))
    return dashboard.totals_panel(totals, TRACKED)


def stars_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.stars_panel(avg_stars(spark, sf_dir), TRACKED)


def language_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = language_bucket(F.col("language"), {"en": "English", "fr": "French"}, "Other")
    return metrics.count_by(repos(spark, sf_dir), bucket.alias("bucket"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = repos(spark, sf_dir).drop("description", "stargazers_count")
    return dedup.rejected_rows(narrow, "id", "seq").select(
        F.col("seq").alias("doc_id"), "language", "reason"
    )


def union_of_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("language"), "n_chars"
    )
    tracked = [documents.where(F.col("language") == name) for name in TRACKED]
    rest = ~F.col("language").isin(*TRACKED) | F.col("language").isNull()
    return union_feeds([*tracked, documents.where(rest)])


# Recency --------------------------------------------------------------------------------------


def recent_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recents(pushes(spark, sf_dir)).select(
        "batch_time", F.col("language").alias("Language"), F.col("recents").alias("Recents")
    )


def recent_last10(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = ranking.last_values(recents(pushes(spark, sf_dir)), "language", "batch_time")
    return last.select(
        "batch_time", F.col("language").alias("Language"), F.col("recents").alias("Recents"), "rank"
    )


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.latest_rows(pushes(spark, sf_dir), "pushed_at", DAY_SECONDS)
    batch = batch_end(F.col("pushed_at"), DAY_SECONDS).alias("batch_time")
    return metrics.count_by(rows, batch, "language")


def dashboard_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.last_batches(pushes(spark, sf_dir), "pushed_at", BATCH_SECONDS)
    return dashboard.recents_panel(recents(rows), TRACKED_TYPES)


def age_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batched(pushes(spark, sf_dir))
    return metrics.age_counts(rows, ["batch_time"], F.col("batch_time"))


def poll_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = filters.in_polls(pushes(spark, sf_dir), "pushed_at", DAY_SECONDS)
    return dedup.latest_page(polls, "poll").select("poll", "language", "id", "pushed_at", "rank")


def batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batched(pushes(spark, sf_dir), DAY_SECONDS)
    return dedup.first_per_batch(rows, "batch_time", ["id"], "seq").select(
        "batch_time", "id", "seq", "language"
    )


# Numbers --------------------------------------------------------------------------------------


def nine_multiples(spark: SparkSession, sf_dir: str) -> DataFrame:
    with view(metrics.divisible_counts(numbers(spark, sf_dir))) as name:
        return spark.sql(f"SELECT isMultipleOf9, count FROM {name} ORDER BY count")


def nine_tumbling_20s(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbers(spark, sf_dir)
    return metrics.divisible_counts(rows, batch_start(F.col("ts"), 20).alias("window_start"))


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divisible and other numbers in windows of five minutes, one every five seconds."""
    rows = numbers(spark, sf_dir).select(
        "ts", metrics.divisible_label(F.col("value")).alias("isMultipleOf9")
    )
    return sliding_counts(rows, "ts", ["isMultipleOf9"], 300, 5)


# Table tour -----------------------------------------------------------------------------------


def digits_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("A"), F.col("o_custkey").alias("B")
    )
    return filters.digits_of_b(filters.raise_b(orders))


def digit_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.digit_histogram(filters.digits_of_b(filters.raise_b(ab_table(spark, sf_dir))))


def odd_numbers_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = filters.odd_only(table(spark, sf_dir, "orders"), "o_orderkey")
    return ranking.first_rows(odd.select("o_orderkey"), 10, "o_orderkey")


def head_15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_rows(ab_table(spark, sf_dir), 15, "B")


def sql_filter_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_size").where("P_SIZE < 4")


def sql_filter_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    with view(table(spark, sf_dir, "part"), everywhere=True) as name:
        return spark.sql(f"SELECT * FROM {name} WHERE p_size < 4")


def sql_count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    with view(table(spark, sf_dir, "part"), everywhere=True) as name:
        return spark.sql(f"SELECT COUNT(p_size) AS n FROM {name} WHERE p_size < 4")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    write_csv(ab_table(spark, sf_dir), path)
    back = read_csv(spark, path, "A BIGINT, B BIGINT")
    return back.groupBy("A").agg(F.count("*").alias("n"), F.sum("B").alias("sum_b"))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a schema: the types are inferred in a pass of their own."""
    path = run_dir(spark, "csv")
    write_csv(ab_table(spark, sf_dir), path)
    back = read_csv(spark, path, None)
    return back.groupBy(F.col("A").cast("bigint").alias("A")).agg(
        F.count("*").alias("n"), F.sum("B").alias("sum_b")
    )


# Report ---------------------------------------------------------------------------------------


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", start, F.col("pushed_at"))
    window = pushes(spark, sf_dir).agg(
        F.min(seconds).alias("started"), F.max(seconds).alias("ended")
    )
    # Totals and words pick their rows with the same winners, which Spark then computes once.
    once = dedup.first_seen_wide(filters.countable(repos(spark, sf_dir)), ["id"], "seq")
    totals = metrics.star_totals(once)
    counts = metrics.word_counts(once)
    lists = ranking.word_lists(ranking.ranked_words(filters.tracked_only(counts, TRACKED)))
    return report_lines(window, totals, lists, TRACKED)


QUERIES = {
    "top10_words": top10_words,
    "top10_words_folded": top10_words_folded,
    "top10_tokens": top10_tokens,
    "top10_words_dedup": top10_words_dedup,
    "word_lists": word_lists,
    "columns_export": columns_export,
    "repo_totals": repo_totals,
    "avg_stars": avg_stars,
    "avg_stars_join": avg_stars_join,
    "totals_zero_filled": totals_zero_filled,
    "stars_zero_filled": stars_zero_filled,
    "language_bucket": language_buckets,
    "rejected_rows": rejected_rows,
    "union_feeds": union_of_feeds,
    "recent_per_batch": recent_per_batch,
    "recent_last10": recent_last10,
    "latest_snapshot": latest_snapshot,
    "dashboard_series": dashboard_series,
    "age_label_counts": age_label_counts,
    "poll_dedup": poll_dedup,
    "batch_dedup": batch_dedup,
    "nine_multiples": nine_multiples,
    "nine_tumbling_20s": nine_tumbling_20s,
    "sliding_counts": sliding_windows,
    "digits_text": digits_text,
    "digit_histogram": digit_histogram,
    "odd_numbers_first10": odd_numbers_first10,
    "head_15": head_15,
    "sql_filter_ci": sql_filter_ci,
    "sql_filter_star": sql_filter_star,
    "sql_count_filter": sql_count_filter,
    "csv_roundtrip": csv_roundtrip,
    "csv_inferred": csv_inferred,
    "run_report": run_report,
}
