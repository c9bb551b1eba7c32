"""The repository stream application: four analyses of one stream, each row taken in once.

Four queries, none of which costs more for a longer history or runs Python:

* **arrivals** writes every row to a table, and **seen** finds the accepted ones (``streaming.intake``);
  each batch is stamped with its logged time. With the new repositories of a batch, ``seen`` adds to the
  totals and average stars of the batch before (a row per language), and counts their words.
* **recents** reads the arrivals as a stream and counts the recently pushed repositories of their
  batches, whether or not they were seen before.
* **words** adds up those word counts in streaming state and keeps the top list.

Snapshots older than a few batches are removed; the history of recent counts holds the last points
of each language.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repotide.fixed import BATCH_SECONDS, HISTORY_LENGTH, RECENT_SECONDS, TOP_WORDS, TRACKED
from repotide.operators.metrics import (
    add_totals,
    average_stars,
    recent_counts,
    star_totals,
    word_counts,
)
from repotide.operators.ranking import as_shown, last_values, word_lists
from repotide.session import make_folder
from repotide.sinks import dashboard, tables
from repotide.sinks.console import show_batch
from repotide.sinks.panels import as_panels, commit_panels, read_panels
from repotide.sinks.report import run_report
from repotide.sinks.tables import forget_batches, latest_batch, publish_once, read_batch, write_batch
from repotide.streaming.intake import PLACE, TAKEN, arrivals, intake_table, rows_at, start_intake
from repotide.streaming.queries import BatchFunction, finish, start
from repotide.streaming.state import RANKED, RUNNING_TOTALS, SNAPSHOTS, keep_top_words

BATCH_TIME = "batch_time"
ROWS = (
    "id {id}, seq {seq}, language STRING, pushed_at TIMESTAMP, stargazers_count BIGINT, "
    f"description STRING, {BATCH_TIME} TIMESTAMP"
)
HISTORY = "batch_time TIMESTAMP, Language STRING, Recents BIGINT"
PANEL_ROWS = "language STRING, item STRING, value STRING"
NEW_WORDS = "language STRING, word STRING, freq BIGINT"


@dataclass
class Results:
    """Named result tables of a run."""

    out: str
    quiet: bool = True

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def publish(self, name: str, rows: DataFrame, batch_id: int, schema: str) -> DataFrame:
        """Write one named result of a batch, and print all of what was written."""
        spark, path = rows.sparkSession, self.path(name)
        write_batch(rows, path, batch_id)
        forget_batches(spark, path, batch_id - SNAPSHOTS)
        written = read_batch(spark, path, batch_id, schema)
        if not self.quiet:
            show_batch(name, datetime.now(timezone.utc), written)
        return written


@dataclass
class NewRepos(Results):
    """Batch function over new repositories: totals and stars so far, and the words of the batch."""

    def __call__(self, new: DataFrame, batch_id: int) -> None:
        spark = new.sparkSession
        totals = star_totals(new)
        if batch_id > 0:
            before = read_batch(spark, self.path("totals"), batch_id - 1, RUNNING_TOTALS)
            totals = add_totals(totals, before)
        write_batch(totals, self.path("totals"), batch_id)
        forget_batches(spark, self.path("totals"), batch_id - SNAPSHOTS)
        totals = read_batch(spark, self.path("totals"), batch_id, RUNNING_TOTALS)
        shown = totals.select(F.col("language").alias("lang"), "count")
        self.publish(tables.COUNTS, shown, batch_id, tables.DASHBOARD[tables.COUNTS])
        self.publish(tables.STARS, average_stars(totals), batch_id, tables.DASHBOARD[tables.STARS])
        texts = rows_at(spark, self.out, "language STRING, description STRING", new.select(TAKEN, PLACE))
        publish_once(word_counts(texts), self.path("new_words"), batch_id)


@dataclass
class Recents(Results):
    """Batch function over arrivals: recent counts and their history."""

    recent_seconds: int = RECENT_SECONDS

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = recent_counts(batch, [BATCH_TIME], F.col(BATCH_TIME), self.recent_seconds)
        recents = counts.select(
            BATCH_TIME, F.col("language").alias("Language"), F.col("recents").alias("Recents")
        )
        recents = self.publish(tables.RECENTS, recents, batch_id, tables.DASHBOARD[tables.RECENTS])
        if batch_id > 0:
            recents = recents.unionByName(read_batch(spark, self.path("history"), batch_id - 1, HISTORY))
        last = last_values(recents, "Language", BATCH_TIME, HISTORY_LENGTH).drop("rank")
        write_batch(last, self.path("history"), batch_id)
        forget_batches(spark, self.path("history"), batch_id - SNAPSHOTS)


def top_panel(out: str, top: int = TOP_WORDS, quiet: bool = True):
    """Batch function over running word counts: keeps and prints the top list, a row per language."""
    path = f"{out}/{tables.TOP}"
    keep = keep_top_words(path, top)

    def run(batch: DataFrame, batch_id: int) -> None:
        keep(batch, batch_id)
        if not quiet:
            ranked = read_batch(batch.sparkSession, path, batch_id, RANKED)
            show_batch(tables.TOP, datetime.now(timezone.utc), word_lists(ranked))

    return run


def start_repo_analytics(
    repos: DataFrame,
    out: str,
    checkpoint: str,
    every_seconds: int | None = BATCH_SECONDS,
    recent_seconds: int = RECENT_SECONDS,
    top: int = TOP_WORDS,
    quiet: bool = True,
    retention: str | None = None,
    languages: Sequence[str] = TRACKED,
    others: bool = False,
) -> list[StreamingQuery]:
    """Run the application on a stream of repositories.

    Input columns: ``id``, ``seq`` (arrival, a number or text), ``language``, ``pushed_at``,
    ``stargazers_count`` and ``description``. Recency is taken at ``batch_time`` where there is such
    a column, else at the time logged for the batch of the intake. Without an interval everything
    that is there is taken in first, then the other queries work it off and end. Rows that are not
    accepted are in ``rejects``. After each batch of recents or words the panels of all four analyses,
    for ``languages`` and, with ``others``, all others that came in, are published together
    (``shown_panels``).
    """
    spark = repos.sparkSession
    if BATCH_TIME not in repos.columns:
        repos = repos.withColumn(BATCH_TIME, F.current_timestamp())
    kinds = {name: repos.schema[name].dataType.simpleString() for name in ("id", "seq")}
    schema = ROWS.format(**kinds)
    repos = repos.select(*(part.split()[0] for part in schema.split(", ")))
    words = f"{out}/new_words"
    make_folder(spark, words)
    intake = start_intake(
        repos,
        "id",
        "seq",
        out,
        f"{checkpoint}/intake",
        every_seconds,
        retention,
        ["language", "stargazers_count"],
        NewRepos(out, quiet),
    )
    if every_seconds is None:
        for query in intake:
            finish(query)
    pushed = f"id {kinds['id']}, language STRING, pushed_at TIMESTAMP, {BATCH_TIME} TIMESTAMP"
    pushes = arrivals(spark, out, pushed, streaming=True)
    counts = spark.readStream.schema(f"{NEW_WORDS}, batch_id BIGINT").parquet(words)
    counts = counts.groupBy("language", "word").agg(F.sum("freq").alias("freq"))
    panels = Dashboard(out, languages, others)
    recents = panels.after(Recents(out, quiet, recent_seconds))
    words = panels.after(top_panel(out, top, quiet))
    return [
        *intake,
        start(pushes, recents, f"{checkpoint}/recents", "append", every_seconds),
        start(counts, words, f"{checkpoint}/words", "update", every_seconds),
    ]


def rejects(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The rows a run did not accept, with the reason.

    ``schema`` names the columns wanted, among them ``id`` and ``language``.
    """
    return intake_table(spark, out, schema, "id").where("not accepted").drop("accepted")


def run_report_of(
    spark: SparkSession,
    out: str,
    started: int,
    ended: int,
    languages: Sequence[str] = TRACKED,
) -> DataFrame:
    """The report of a run from the tables it left; times are epoch seconds."""
    window = spark.range(1).select(F.lit(started).alias("started"), F.lit(ended).alias("ended"))
    totals = latest_batch(spark, f"{out}/totals", RUNNING_TOTALS)
    top = latest_batch(spark, f"{out}/{tables.TOP}", RANKED)
    return run_report(window, totals, word_lists(top), languages)


def latest_dashboard(
    spark: SparkSession, out: str, languages: Sequence[str] = TRACKED, others: bool = False
) -> dict[str, DataFrame]:
    """The four panels: totals and average stars with zeros for tracked languages that have none,
    the last points of recent counts, and the top words of each language as a list."""
    counts = latest_batch(spark, f"{out}/{tables.COUNTS}", tables.DASHBOARD[tables.COUNTS])
    stars = latest_batch(spark, f"{out}/{tables.STARS}", tables.DASHBOARD[tables.STARS])
    history = latest_batch(spark, f"{out}/history", HISTORY)
    top = latest_batch(spark, f"{out}/{tables.TOP}", RANKED)
    series = history.select(
        BATCH_TIME, F.col("Language").alias("language"), F.col("Recents").alias("recents")
    )
    return {
        tables.COUNTS: dashboard.totals_panel(counts.withColumnRenamed("lang", "language"), languages, others),
        tables.STARS: dashboard.stars_panel(stars, languages, others),
        tables.RECENTS: dashboard.recents_panel(series, languages, others=others),
        tables.TOP: word_lists(top),
    }


def dashboard_rows(
    spark: SparkSession, out: str, languages: Sequence[str] = TRACKED, others: bool = False
) -> DataFrame:
    """The four panels in one long table: (panel, language, item, value)."""
    panels = latest_dashboard(spark, out, languages, others)

    def shown(name: str, language: str, item: Column, value: Column) -> DataFrame:
        return panels[name].select(
            F.col(language).alias("language"), item.alias("item"), value.cast("string").alias("value")
        )

    column = F.col
    average = F.format_number(column("Average_Stars"), 4)
    return as_panels(
        {
            tables.COUNTS: shown(tables.COUNTS, "lang", F.lit("count"), column("count")),
            tables.STARS: shown(tables.STARS, "Language", F.lit("stars"), average),
            tables.RECENTS: shown(tables.RECENTS, "Language", column("label"), column("Recents")),
            tables.TOP: shown(tables.TOP, "language", F.lit(""), column("words")),
        }
    )


@dataclass
class Dashboard:
    """Batch functions that publish all four panels as one commit when they are done.

    The queries of an application share one; a commit holds the newest results of each.
    """

    out: str
    languages: Sequence[str] = TRACKED
    others: bool = False
    turn: Lock = field(default_factory=Lock)

    def after(self, on_batch: BatchFunction) -> BatchFunction:
        def run(batch: DataFrame, batch_id: int) -> None:
            on_batch(batch, batch_id)
            with self.turn:
                rows = dashboard_rows(batch.sparkSession, self.out, self.languages, self.others)
                commit_panels(rows, f"{self.out}/dashboard")

        return run


def shown_panels(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The four panels as they were last published together."""
    return read_panels(spark, f"{out}/dashboard", PANEL_ROWS)


def top_words_table(spark: SparkSession, out: str) -> DataFrame:
    """The newest top list, one row per word."""
    return as_shown(latest_batch(spark, f"{out}/{tables.TOP}", RANKED))
