"""Top words of a stream without its vocabulary in state.

What is kept between batches does not grow with the words seen: a counting sketch of ``DEPTH`` times ``WIDTH``
cells per language, and a short list of candidates. A word's estimate, the least of its cells, is never below its
count. A word of a batch that does not make the list has an estimate no higher than the best one dropped,
which is kept as ``dropped``, and so has its count until it comes again and is judged anew.

The list itself is made by a second pass over the stored rows, which counts the candidates exactly. It is proven if
the last count on it is above everything dropped; if not, the pass is widened to all words whose estimate
reaches that count, among which the true list must be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.fixed import TOP_WORDS
from repotide.operators.dedup import top_rows
from repotide.operators.metrics import word_counts, word_rows
from repotide.operators.ranking import ranked_words
from repotide.sinks.tables import forget_batches, latest_batch, read_batch, write_batch
from repotide.streaming.queries import BatchFunction
from repotide.streaming.state import SNAPSHOTS

DEPTH, WIDTH = 4, 4096
# Words on the list of candidates of a language.
CANDIDATES = 100

CELLS = "language STRING, line INT, cell INT, n BIGINT"
LISTED = "language STRING, word STRING, estimate BIGINT"
DROPPED = "language STRING, dropped BIGINT"


def _with_cells(words: DataFrame, width: int) -> DataFrame:
    """Each word as often as the sketch has lines, with its cell in each."""
    lines = F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1))).alias("line")
    rows = words.select("*", lines)
    return rows.withColumn("cell", F.pmod(F.xxhash64("line", "word"), F.lit(width)).cast("int"))


def sketch_of(counts: DataFrame, width: int = WIDTH) -> DataFrame:
    """The cells of words with their counts ``freq``."""
    cells = _with_cells(counts.select("language", "word", "freq"), width)
    return cells.groupBy("language", "line", "cell").agg(F.sum("freq").alias("n"))


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("language", "line", "cell").agg(F.sum("n").alias("n"))


def estimates(words: DataFrame, cells: DataFrame, width: int = WIDTH) -> DataFrame:
    """(language, word, estimate) of distinct words (language, word)."""
    found = _with_cells(words, width).join(cells, ["language", "line", "cell"])
    return found.groupBy("language", "word").agg(F.min("n").alias("estimate"))


def keep_candidates(path: str, width: int = WIDTH, candidates: int = CANDIDATES) -> BatchFunction:
    """Keep the sketch, the candidates and what was dropped, from batches of repositories.

    A batch reads the snapshots of the batch before it, so one that is repeated writes the same.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def stored(rows: DataFrame, name: str, schema: str) -> DataFrame:
            write_batch(rows, f"{path}/{name}", batch_id)
            forget_batches(spark, f"{path}/{name}", batch_id - SNAPSHOTS)
            return read_batch(spark, f"{path}/{name}", batch_id, schema)

        def before(name: str, schema: str) -> DataFrame:
            if batch_id == 0:
                return spark.createDataFrame([], schema)
            return read_batch(spark, f"{path}/{name}", batch_id - 1, schema)

        counts = stored(word_counts(batch), "counted", "language STRING, word STRING, freq BIGINT")
        cells = stored(merged(sketch_of(counts, width), before("cells", CELLS)), "cells", CELLS)
        words = counts.select("language", "word").union(before("listed", LISTED).select("language", "word"))
        judged = top_rows(
            estimates(words.distinct(), cells, width), ["language"], [F.desc("estimate"), F.col("word")], candidates + 1
        )
        # The first word that is not on the list is the best one dropped.
        judged = stored(judged, "judged", f"{LISTED}, rank INT")
        stored(judged.where(F.col("rank") <= candidates).drop("rank"), "listed", LISTED)
        out = judged.where(F.col("rank") > candidates).select("language", F.col("estimate").alias("dropped"))
        out = out.unionByName(before("dropped", DROPPED)).groupBy("language").agg(F.max("dropped").alias("dropped"))
        stored(out, "dropped", DROPPED)

    return keep


def _exact(repos: DataFrame, words: DataFrame) -> DataFrame:
    """Counts of the given distinct words alone."""
    wanted = words.select("language", "word")
    rows = word_rows(repos).join(wanted, ["language", "word"], "left_semi")
    return rows.groupBy("language", "word").agg(F.count("*").alias("freq"))


def top_words_of(repos: DataFrame, path: str, n: int = TOP_WORDS, width: int = WIDTH) -> tuple[DataFrame, list[str]]:
    """The exact top list of all rows that went through ``keep_candidates``, and the languages it was widened for.

    ``repos`` are those rows, stored.
    """
    spark = repos.sparkSession
    listed = latest_batch(spark, f"{path}/listed", LISTED)
    dropped = latest_batch(spark, f"{path}/dropped", DROPPED)
    top = ranked_words(_exact(repos, listed), n)
    # As many rows as languages.
    least = top.groupBy("language").agg(F.min("freq").alias("least"), F.count("*").alias("had"))
    open_ = least.join(dropped, "language", "left").where(
        (F.col("dropped") >= F.col("least")) | (F.col("had") < n) & F.col("dropped").isNotNull()
    )
    widened = {row["language"]: row["least"] if row["had"] == n else 0 for row in open_.collect()}
    if not widened:
        return top, []
    names = list(widened)
    cells = latest_batch(spark, f"{path}/cells", CELLS)
    own = repos.where(F.col("language").isin(names))
    reach = F.element_at(F.create_map(*(F.lit(x) for pair in widened.items() for x in pair)), F.col("language"))
    # The words that may be on the list are few, unless the sketch is far too narrow.
    words = estimates(word_rows(own).distinct(), cells, width).where(F.col("estimate") >= reach)
    again = ranked_words(_exact(own, words), n)
    return top.where(~F.col("language").isin(names)).unionByName(again), sorted(names)
