"""Benchmark decontamination by SimHash windows and a multi-index of Hamming blocks.

A document's windows of an item's number of words are compared with the items:

* Only windows that start at a run of five words which an item of that size holds are made. A window
  without a common run has similarity 0, and moving a window on to its first common run never lowers
  its similarity, so nothing is lost. A window that would pass the end is moved back to it.
* Each window has a 64-bit SimHash over its runs, weighted by how often they occur.
* **Multi-index.** Fingerprints are cut into four blocks of 16 bits. Two that differ in at most ``RADIUS``
  = 15 bits differ in at most 3 bits of some block, so each block of an item is entered with all its
  variants of up to 3 bits; a window probes with its blocks as they are. Every item within the
  radius is found.
* Candidates are verified by exact weighted Jaccard: sum of the smaller over sum of the larger counts.

At similarity 0.8 two fingerprints differ in about 10 of 64 bits, with a deviation of 3. Exact copies
of an item differ in none. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import SHINGLE_WORDS, hinted, read, stored, word_hashes

SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, VARIANT_BITS = 4, 16, 3
RADIUS = BLOCKS * (VARIANT_BITS + 1) - 1


def with_runs(rows: DataFrame, *kept: str) -> DataFrame:
    """``runs``: hashes of the runs of five words of ``text``, in order; null for shorter texts.

    Explode them by an outer generator and filter afterwards: a filter on their number would be
    pushed into the lambda's input, which would then be computed again for every run.
    """
    hashed = rows.select(*kept, word_hashes(F.col("text")).alias("h"))
    places = F.sequence(F.lit(0), F.size("h") - SHINGLE_WORDS)
    run = lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(SHINGLE_WORDS)])
    runs = F.when(F.size("h") >= SHINGLE_WORDS, F.transform(places, run))
    return hashed.select(*kept, runs.alias("runs"))


def simhash(rows: DataFrame, *key: str) -> DataFrame:
    """The key with ``fingerprint`` over ``runs``: a bit is set if it is in more than half of them.

    32 sums hold two counters of 32 bits each.
    """
    exploded = rows.select(*key, F.explode("runs").alias("run"))
    pair = F.lit((1 << 32) + 1)
    sums = [F.sum(F.shiftrightunsigned("run", j).bitwiseAND(pair)).alias(f"s{j}") for j in range(32)]
    counted = exploded.groupBy(*key).agg(F.count("*").alias("n"), *sums)
    fingerprint = F.lit(0).cast("bigint")
    for j in range(32):
        for half in (0, 1):
            ones = F.shiftrightunsigned(f"s{j}", 32 * half).bitwiseAND(F.lit((1 << 32) - 1))
            bit = 1 << (j + 32 * half)
            bit = bit - (1 << 64) if bit >= 1 << 63 else bit
            fingerprint = fingerprint.bitwiseOR(F.when(ones * 2 > F.col("n"), F.lit(bit)).otherwise(0))
    return counted.select(*key, fingerprint.alias("fingerprint"))


def block(fingerprint: Column | str, i: int) -> Column:
    moved = F.shiftrightunsigned(fingerprint, BLOCK_BITS * i)
    return moved.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def blocks(fingerprint: Column | str) -> Column:
    """One (i, value) for each block."""
    return F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), block(fingerprint, i).alias("value")) for i in range(BLOCKS)])
    )


def numbered(runs: Column | str) -> Column:
    """Runs as a set: a run that occurs again becomes another element, named by its turn."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    turn = lambda x, i: F.size(F.filter(F.slice(runs, F.lit(1), i), lambda y: y == x))
    again = F.transform(
        runs, lambda x, i: F.when(turn(x, i) > 0, F.xxhash64(x, turn(x, i))).otherwise(x)
    )
    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), runs).otherwise(again)


def item_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(text_id, start, size, runs): the windows that need comparing, once for equal texts."""
    wanted = items.select(F.explode("runs").alias("run"), F.size("runs").alias("size")).distinct()
    wanted = hinted(stored(wanted, "wanted"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text")
    runs = with_runs(rows, "doc_id", "text_id")
    placed = runs.select("doc_id", "text_id", F.posexplode_outer("runs").alias("start", "run"))
    hits = placed.join(wanted, "run").groupBy("text_id")
    hits = hits.agg(F.collect_set(F.struct("start", "size")).alias("hits"), F.min("doc_id").alias("rep"))
    found = hinted(stored(hits.withColumnRenamed("text_id", "of"), "hits"))
    own = rows.join(found, (F.col("text_id") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    own = with_runs(own, "text_id", "hits")
    last = F.size("runs")
    starts = F.array_distinct(
        F.transform(
            "hits",
            lambda hit: F.struct(
                F.greatest(F.least(hit["start"], last - hit["size"]), F.lit(0)).alias("start"),
                hit["size"].alias("size"),
            ),
        )
    )
    windows = own.select("text_id", "runs", F.explode_outer(starts).alias("w"))
    own = F.slice("runs", F.col("w.start") + 1, F.col("w.size")).alias("runs")
    windows = windows.select("text_id", "w.start", "w.size", own)
    return windows.dropDuplicates(["text_id", "start", "size"])


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per distinct text and item that a window of it is like: text_id, item_id and what
    ``contaminated`` has."""
    items = benchmark.select("item_id", F.xxhash64("text").alias("item_text"), "text")
    items = with_runs(items, "item_id", "item_text").dropDuplicates(["item_id", "item_text"])
    items = stored(items, "items").where("runs is not null")
    windows = stored(item_windows(docs, items), "windows")
    key = ["text_id", "start", "size"]
    marked = stored(simhash(windows, *key), "fingerprints")
    masks = F.filter(
        F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda x: F.bit_count(x) <= VARIANT_BITS
    )
    indexed = simhash(items, "item_id", "item_text").select(
        "item_id", "item_text", F.col("fingerprint").alias("item_print"), blocks("fingerprint").alias("b")
    )
    indexed = indexed.withColumn("mask", F.explode(masks))
    value = F.col("b.value").bitwiseXOR(F.col("mask"))
    indexed = indexed.select("item_id", "item_text", "item_print", "b.i", value.alias("value"))
    probes = marked.select("fingerprint").distinct()
    probes = probes.select("fingerprint", blocks("fingerprint").alias("b"))
    probes = probes.select("fingerprint", "b.i", "b.value")
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS
    pairs = probes.join(indexed, ["i", "value"]).where(near)
    pairs = stored(pairs.select("fingerprint", "item_id", "item_text").distinct(), "pairs")
    sets = items.select("item_id", "item_text", numbered("runs").alias("item_runs"))
    candidates = (
        marked.join(hinted(pairs), "fingerprint")
        .join(windows.withColumn("own_runs", numbered("runs")).drop("runs"), key)
        .join(hinted(stored(sets, "sets")), ["item_id", "item_text"])
    )
    both = F.size(F.array_intersect("own_runs", "item_runs"))
    alike = both / (F.size("own_runs") + F.size("item_runs") - both)
    found = candidates.withColumn("similarity", alike).where(F.col("similarity") >= similarity)
    words = (F.col("size") + SHINGLE_WORDS - 1).alias("n_words")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), words)).alias("best")
    n_windows = F.count_distinct("start", "size").alias("n_windows")
    return found.groupBy("text_id", "item_id").agg(best, n_windows).select(
        "text_id",
        "item_id",
        "best.similarity",
        (-F.col("best.back")).alias("start_word"),
        "best.n_words",
        "n_windows",
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item that a window of it is like.

    doc_id, item_id, ``similarity`` of the best window, the word where it starts, how long it is in
    words, and the number of such windows. Null, empty and short texts (under five words) match
    nothing, on either side. Rows equal in number and text are one document; a null number is a
    number like any other. Items of one number are one item of several texts. Very long texts are searched
    whole; the work on a window that holds a run more than once grows with the square of its item's length. Other columns are
    ignored; empty tables give no rows.
    """
    found = stored(contaminated_texts(docs, benchmark, similarity), "contaminated")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"))
    return rows.join(hinted(found), "text_id").distinct().drop("text_id")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without those that are like an item anywhere."""
    found = stored(contaminated_texts(docs, benchmark, similarity).select("text_id").distinct(), "contaminated")
    found = found.withColumnRenamed("text_id", "of")
    return docs.join(hinted(found), F.xxhash64(docs["text"]) == F.col("of"), "left_anti")


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
