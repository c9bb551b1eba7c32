"""Substring dedup of paragraphs by MinHash banding.

A paragraph is a line with a run of five words; shorter lines have none and stay, unless ``min_words`` is 1,
when they are compared as a whole: those of the same words are alike. Paragraphs of the
same words are one class. Each class has a MinHash signature over its runs of five words. The bands
are tuned for recall (``bands_for``); classes that collide in a band are compared exactly, by Jaccard
similarity, in blocks within tasks. Links join classes to components, of which the first paragraph
by document number and line stays and all others go, copies included. Passages that repeat within longer
lines, or across line ends, go too (``passages``).

As in any bucketing, a bucket may be hot. Its pairs are never rows: tasks return only links that join
something, at most one less than the members that meet in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import (
    SEPARATORS,
    SHINGLE_WORDS,
    Forest,
    grouped,
    hinted,
    in_blocks,
    mixed,
    ragged,
    read,
    shingles,
    stored,
    words,
)
from repotide.llm.components import components
from repotide.llm.passages import RUN, repeated_passages, without_words

SIMILARITY = 0.8
MIN_WORDS = SHINGLE_WORDS
BAND_ROWS = 3
# Chance that a pair at the threshold is compared.
RECALL = 0.9995
BLOCK = 1024
STEP = 200_000

SIGNED = "doc_id BIGINT, text_id BIGINT, line INT, n_words INT, class BINARY, bands ARRAY<BIGINT>"


def bands_for(similarity: float, band_rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands in which a pair of this similarity collides with the wanted chance."""
    miss, bands = 1.0, 0
    while 1 - miss < recall:
        miss *= 1 - similarity**band_rows
        bands += 1
    return bands


def minhash(elements: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """The smallest of ``size`` hashes of each row's elements; every row has at least one."""
    out = np.empty((len(ends) - 1, size), np.uint64)
    for j in range(size):
        seed = np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        hashed = (elements ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
        out[:, j] = np.minimum.reduceat(hashed * seed, ends[:-1])
    return out


def _class(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.astype(np.int64).tobytes(), digest_size=16).digest()


def _sign(bands: int, band_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Short lines go here, as a filter in the plan would cut all lines into words twice.
            batch = batch.filter(batch.column("hashes").is_valid())
            for start in range(0, len(batch), STEP // 50):
                part = batch.slice(start, STEP // 50)
                values, offsets = ragged(part.column("hashes"))
                elements, ends = shingles(values, offsets)
                signed = minhash(elements, ends, bands * band_rows)
                keys = np.zeros((len(part), bands), np.uint64)
                for j in range(band_rows):
                    keys = mixed(keys + signed[:, j::band_rows] + np.uint64(j + 1))
                spans = zip(offsets[:-1], offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "text_id", "line")),
                        pa.array(np.diff(offsets).astype(np.int32)),
                        pa.array([_class(values[a:b]) for a, b in spans], pa.binary()),
                        pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_id", "line", "n_words", "class", "bands"],
                )

    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, offsets = ragged(batch.column("hashes"))
        elements, ends = shingles(values, offsets)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_class(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
                pa.array([np.unique(elements[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
            ],
            ["class", "elements"],
        )


def _compare(similarity: float):
    def pairs(members: list[dict], split: int, band: int) -> Iterator[tuple[bytes, bytes]]:
        """Links between members before and from ``split``, or among all if it is 0."""
        sets = [frozenset(np.frombuffer(m["elements"], np.uint64).tolist()) for m in members]
        sizes = np.array([len(s) for s in sets])
        bands = np.array([m["bands"] for m in members])
        forest = Forest(len(members))
        for i in range(split or len(members)):
            start = split or i + 1
            # Jaccard can't exceed the ratio of sizes; a pair is looked at in its first common band.
            small, large = np.minimum(sizes[start:], sizes[i]), np.maximum(sizes[start:], sizes[i])
            fits = small >= similarity * large
            fits &= ~(bands[start:, :band] == bands[i, :band]).any(axis=1)
            likely = (bands[start:] == bands[i]).sum(axis=1)
            found = np.flatnonzero(fits)
            for j in found[np.argsort(-likely[found], kind="stable")]:
                j = int(j) + start
                if forest.root(i) != forest.root(j):
                    both = len(sets[i] & sets[j])
                    if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                        forest.join(i, j)
                        yield members[i]["class"], members[j]["class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "task"):
            same = rows[0]["low"] == rows[0]["high"]
            low = [r for r in rows if r["side"] == r["low"]]
            high = [] if same else [r for r in rows if r["side"] == r["high"]]
            found = list(pairs(low + high, 0 if same else len(low), rows[0]["band"])) if low and (same or high) else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_id, line, hashes): all lines, with the word hashes of those long enough."""
    return _hashed(_lines(docs), min_words)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, line, own): all lines; a row of a line does not carry the whole text."""
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.split("text", "\n").alias("lines"))
    return cut.select("doc_id", "text_id", F.posexplode_outer("lines").alias("line", "own"))


def _hashed(lines: DataFrame, min_words: int) -> DataFrame:
    split = F.array_remove(F.split(F.lower("own"), SEPARATORS), "").alias("w")
    lines = lines.select("doc_id", "text_id", "line", split)
    hashes = F.when(F.size("w") >= max(1, min_words), F.transform("w", lambda w: F.xxhash64(w)))
    return lines.select("doc_id", "text_id", "line", hashes.alias("hashes"))


def repeated_paragraphs(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    min_words: int = MIN_WORDS,
    band_rows: int = BAND_ROWS,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, text_id, line, n_words, component, removed): the paragraphs that occur more than once.

    ``component`` is the class that names a component, ``removed`` is false for its first paragraph.
    """
    bands = bands_for(similarity, band_rows, recall)
    signed = stored(paragraphs(docs, min_words).mapInArrow(_sign(bands, band_rows), SIGNED), "paragraphs")
    # One paragraph of each class, found by its place; taken here, as a join of all of a hot class would be one task.
    at = F.min(F.struct("doc_id", "text_id", "line")).alias("at")
    classes = signed.groupBy("class").agg(F.count("*").alias("n"), F.first("bands").alias("bands"), at)
    classes = stored(classes, "paragraph_classes")
    keyed = classes.select("class", F.posexplode("bands").alias("band", "key"))
    buckets = (
        keyed.groupBy("band", "key")
        .agg(F.count("*").alias("n_members"), F.bit_xor(F.xxhash64("class")).alias("who"))
        .where("n_members > 1")
        .groupBy("n_members", "who")
        .agg(F.min(F.struct("band", "key")).alias("bucket"))
        .select("bucket.*", "n_members")
    )
    members = stored(keyed.join(buckets, ["band", "key"]), "colliding")
    needed = members.select("class").distinct()
    places = classes.join(needed, "class")
    places = stored(places.select(F.col("at.doc_id").alias("d"), F.col("at.text_id").alias("t"), F.col("at.line").alias("l")), "places")
    at = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_id") == F.col("t")) & (F.col("line") == F.col("l"))
    # Lines are cut into words only after the join.
    chosen = _hashed(_lines(docs).join(hinted(places), at, "left_semi"), min_words)
    sets = chosen.select("hashes").mapInArrow(_weigh, "class BINARY, elements BINARY")
    sets = sets.groupBy("class").agg(F.first("elements").alias("elements")).join(classes.drop("n", "at"), "class")
    dealt = in_blocks(members, ["band", "key"], "class", block)
    dealt = dealt.select("class", "band", "side", "low", "high", "task")
    tasks = dealt.join(stored(sets, "paragraph_sets"), "class").repartition("task").sortWithinPartitions("task")
    found = components(tasks.mapInArrow(_compare(similarity), "a BINARY, b BINARY"))
    joined = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    joined = joined.where("n > 1 or component is not null")
    joined = stored(joined.select("class", F.coalesce("component", "class").alias("component")), "repeated")
    own = signed.drop("bands").join(hinted(joined), "class")
    own = stored(own.drop("class"), "repeated_paragraphs")
    first = own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "line")).alias("first"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "line")
    marked = own.join(hinted(stored(first, "first")), "component").withColumn("removed", place != F.col("first"))
    return marked.drop("first")


def remove_repeated(docs: DataFrame, **how: object) -> DataFrame:
    """Per document what is left without paragraphs, and without passages within them, that occurred before.

    ``n_lines``, ``n_repeated`` (paragraphs with another like them anywhere), ``n_removed``, ``removed``
    (their lines, from 0), ``n_bytes``, ``removed_bytes`` (of the text, with line ends), ``kept_sha256``,
    ``n_passages`` and ``passage_words`` (stretches of words, and how many words, in runs of ``RUN`` words that
    another document holds too), ``cut_words`` and ``kept``, the text that is left. Besides removed lines, a run in
    lines that stay goes if an earlier document holds it in lines that stay; line ends within it stay. Runs are
    judged on the input. A null text stays null and has no lines. Rows equal in number
    and text are one document, so the first paragraph may stay in each of them. Rows without a
    number come last. A very long text is cut into its lines by Spark, one row each; a single very long
    line is one paragraph, signed in memory of a few times its size. Other columns are ignored; no rows
    give no rows.
    """
    found = repeated_paragraphs(docs, **how)
    lines = found.groupBy("doc_id", "text_id").agg(
        F.count_distinct("line").cast("int").alias("n_repeated"),
        F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line")))).alias("removed"),
    )
    lines = stored(lines, "removed_lines")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text")
    least, most, numbered = F.min("doc_id"), F.max("doc_id"), F.count("doc_id")
    # By text: its first document, and whether there is a second one.
    copies = rows.where("text is not null").groupBy("text_id").agg(
        least.alias("rep"),
        F.coalesce((least != most) | ((numbered > 0) & (numbered < F.count("*"))), F.lit(False)).alias("shared"),
        F.count("*").alias("n"),
    )
    copies = stored(copies.where("n > 1").drop("n"), "text_copies")
    is_first = F.col("shared").isNull() | F.col("doc_id").eqNullSafe(F.col("rep"))
    once = rows.where("text is not null").join(hinted(copies), "text_id", "left").where(is_first)
    once = once.select("text_id", F.col("doc_id").alias("rep"), "text")
    gone = lines.join(hinted(copies), "text_id", "left").where(is_first).select("text_id", "removed")
    passages = repeated_passages(once, gone)
    lines = lines.withColumnsRenamed({"doc_id": "d", "text_id": "t"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_id") == F.col("t"))
    rows = rows.join(hinted(lines), same, "left")
    rows = rows.join(hinted(copies), "text_id", "left").join(hinted(passages), "text_id", "left")
    none = F.array().cast(passages.schema["cuts"].dataType)
    rows = rows.withColumn("cuts", F.when(is_first & F.col("cuts").isNotNull(), F.col("cuts")).otherwise(none))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    text = F.when(F.size("cuts") > 0, without_words(F.col("text"), F.col("cuts"))).otherwise(F.col("text"))
    rows = rows.withColumn("lines", F.split(text, "\n"))
    # What is left by a set difference of line numbers, which costs no more than the lines.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), removed)
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    kept = F.when((F.size(removed) == 0) & (F.size("cuts") == 0), F.col("text")).otherwise(kept)
    left = F.coalesce(kept, F.lit(""))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    # A text with a second document is one passage, if it is long enough.
    whole = F.when(F.col("shared") & F.col("text").isNotNull(), F.size(words(F.col("text"))))
    return rows.withColumn("whole", F.when(whole >= RUN, whole)).select(
        "doc_id",
        F.greatest(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"),
        F.size(removed).alias("n_removed"),
        removed.alias("removed"),
        size.alias("n_bytes"),
        (size - F.octet_length(left)).cast("bigint").alias("removed_bytes"),
        F.sha2(left, 256).alias("kept_sha256"),
        F.when(F.col("whole").isNotNull(), 1).otherwise(F.coalesce("n_passages", F.lit(0))).alias("n_passages"),
        F.coalesce("whole", "passage_words", F.lit(0)).alias("passage_words"),
        F.aggregate("cuts", F.lit(0), lambda n, c: n + c["end"] - c["start"]).alias("cut_words"),
        kept.alias("kept"),
    )


def op2_paragraph_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(read(spark, sf_dir, "documents")).drop("kept")
