"""Aggregations. All of them combine before their shuffle and hash on fixed-width buffers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.fixed import RECENT_SECONDS, TRACKED
from repotide.functions.numbers import divisible_label, ratio_or_zero
from repotide.functions.text import split_commas, tokens
from repotide.functions.times import age_label, is_recent
from repotide.operators.dedup import newest_pushes
from repotide.operators.filters import tracked_only, with_description, with_language


def count_by(rows: DataFrame, *keys: str | Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("count"))


def repo_totals(repos: DataFrame) -> DataFrame:
    return count_by(repos, "language")


def star_totals(repos: DataFrame) -> DataFrame:
    """Repositories and star sum per language, from one pass."""
    return repos.groupBy("language").agg(
        F.count("*").alias("count"), F.sum("stargazers_count").alias("stars")
    )


def add_totals(totals: DataFrame, more: DataFrame) -> DataFrame:
    """Two results of ``star_totals`` over different repositories as one."""
    return totals.unionByName(more).groupBy("language").agg(
        F.sum("count").alias("count"), F.sum("stars").alias("stars")
    )


def average_stars(totals: DataFrame) -> DataFrame:
    """Star sum over number of repositories, from the output of ``star_totals``."""
    return totals.select(
        F.col("language").alias("Language"),
        ratio_or_zero(F.col("stars"), F.col("count")).alias("Average_Stars"),
    )


def average_stars_joined(counts: DataFrame, stars: DataFrame) -> DataFrame:
    """The same from two separate results joined on language.

    ``star_totals`` needs no join and is the form to prefer.
    """
    return average_stars(counts.join(stars, "language", "inner"))


def word_rows(repos: DataFrame, fold_case: bool = False, keep_empty: bool = False) -> DataFrame:
    """One row per language and word occurrence."""
    rows = with_description(with_language(repos)).select(
        "language", F.explode(tokens(F.col("description"), fold_case)).alias("word")
    )
    # Dropping empty words after the explode keeps the whole stage in generated code.
    return rows if keep_empty else rows.where(F.col("word") != "")


def word_counts(repos: DataFrame, fold_case: bool = False, keep_empty: bool = False) -> DataFrame:
    return word_rows(repos, fold_case, keep_empty).groupBy("language", "word").agg(
        F.count("*").alias("freq")
    )


def recent_counts(
    pushes: DataFrame, batch: Sequence[str], now: Column, seconds: int = RECENT_SECONDS
) -> DataFrame:
    """Repositories per batch and language whose newest push is at most ``seconds`` old.

    A repository counts once per batch; languages without a recent one keep a zero. The flag is a
    plain column before it is counted, as an aggregate must not hold a clock.
    """
    flagged = newest_pushes(pushes, batch).withColumn(
        "is_recent", is_recent(F.col("pushed_at"), now, seconds)
    )
    return flagged.groupBy(*batch, "language").agg(F.count_if("is_recent").alias("recents"))


def age_counts(
    pushes: DataFrame, batch: Sequence[str], now: Column, seconds: int = RECENT_SECONDS
) -> DataFrame:
    """Old and recent rows per batch, not split by language."""
    labelled = pushes.withColumn("label", age_label(F.col("pushed_at"), now, seconds))
    return count_by(labelled, *batch, "label")


def divisible_counts(numbers: DataFrame, *keys: str | Column) -> DataFrame:
    """How many numbers are divisible and how many are not."""
    label = divisible_label(F.col("value")).alias("isMultipleOf9")
    return count_by(numbers, *keys, label)


def digit_histogram(table: DataFrame) -> DataFrame:
    """Occurrences of each character in the comma-joined texts of column B."""
    return count_by(table.select(F.explode(split_commas(F.col("B"))).alias("digit")), "digit")


def language_table(spark: SparkSession, languages: Sequence[str] = TRACKED) -> DataFrame:
    """The tracked languages as rows, made from one literal."""
    names = F.array(*(F.lit(name) for name in languages))
    return spark.range(1).select(F.posexplode(names).alias("position", "language"))


def tracked_lookup(
    result: DataFrame, values: Sequence[str], languages: Sequence[str] = TRACKED
) -> DataFrame:
    """One row per tracked language with its values, null where a result has none.

    Grouping by language leaves at most ``len(languages)`` rows to broadcast, whatever comes in;
    it adds no shuffle to a result that is grouped by language already.
    """
    known = tracked_only(result, languages).groupBy("language").agg(
        *(F.max(value).alias(value) for value in values)
    )
    table = language_table(result.sparkSession, languages)
    return table.join(F.broadcast(known), "language", "left")


def zero_fill(result: DataFrame, value: str, languages: Sequence[str] = TRACKED) -> DataFrame:
    """One row per tracked language, zero where a result has none."""
    filled = tracked_lookup(result, [value], languages)
    return filled.select("position", "language", F.coalesce(value, F.lit(0)).alias(value))
