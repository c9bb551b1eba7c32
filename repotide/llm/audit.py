"""How five filters interact: what each removes, in any order, after and besides the others.

A document fails some of the filters, and survives every subset of the filters that holds none of these. The
32 subsets are the bits of a word, so a document's survival is one 32-bit word, an entry of the truth table
by the set of filters it fails. How many documents survive each subset is the positional popcount of
their words. Words are added up by carry-save adders: three words of one weight become a sum of that weight
and a carry of twice the weight, until two are left of each weight, whose bits are counted. Counts are
made per part and label within tasks; a part holding most rows costs a row per batch.

All that an order of the filters tells is a difference of survivors of two subsets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import read, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# A, B: the fewest words, the least percentage of different words. C: the most percentage of capitals.
LEAST_WORDS, LEAST_DIFFERENT, MOST_CAPITALS = 100, 80, 10
# D: none of these.
SIGNS = b"#$%&*|"
# Bytes of a text that are cut into words at once.
CHUNK = 1 << 20

CAPITALS = bytes(range(65, 91))
# Bytes that go on a character.
GOING_ON = bytes(range(128, 192))
# What separates words: the same bytes as bytes.split() takes.
BLANKS = b" \t\n\v\f\r"

# Labels a document is counted under.
EVERY, GOOD, TOXIC = "every", "good", "toxic"

# By the set of failed filters, the subsets that have none of them, as bits.
TRUTH = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words, a longer word in one piece."""
    start = 0
    while len(text) - start > CHUNK:
        end = start + CHUNK
        while end < len(text) and text[end] not in BLANKS:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def failed_filters(text: bytes) -> int:
    """The filters A to D that a text in UTF-8 fails, as bits 0 to 3."""
    n_words, different = 0, set()
    for piece in _chunks(text):
        found = piece.split()
        n_words += len(found)
        different.update(found)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    characters = len(text.translate(None, GOING_ON))
    return (
        (n_words < LEAST_WORDS)
        | (100 * len(different) < LEAST_DIFFERENT * n_words) << 1
        | (100 * capitals > MOST_CAPITALS * characters) << 2
        | any(sign in text for sign in SIGNS) << 3
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        failed = [failed_filters(text.as_buffer().to_pybytes()) for text in batch.column("text")]
        columns = {name: batch.column(name) for name in ("doc_id", "part", "key")}
        yield pa.RecordBatch.from_pydict({**columns, "failed": pa.array(failed, pa.int32())})


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit, by a tree of carry-save adders."""
    counts, weight = np.zeros(32, np.int64), 0
    while len(words):
        carries = [words[:0]]
        while len(words) > 2:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n :]])
        for word in words:
            counts += ((int(word) >> np.arange(32)) & 1) << weight
        words, weight = np.concatenate(carries), weight + 1
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, label, survivors): the popcounts of a batch."""
    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        part = parts.indices.to_numpy(zero_copy_only=False)
        words = TRUTH[batch.column("failed").to_numpy(zero_copy_only=False)]
        under = {EVERY: np.ones(len(words), bool)}
        for label in (GOOD, TOXIC):
            under[label] = batch.column(label).to_numpy(zero_copy_only=False)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order])) + 1
        out: list[tuple] = []
        for own in np.split(order, edges):
            if len(own):
                name = parts.dictionary[int(part[own[0]])].as_py()
                out += [(name, label, positional_popcounts(words[own[which[own]]]).tolist()) for label, which in under.items()]
        if out:
            names, labels, counts = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(labels, pa.string()), pa.array(counts, pa.list_(pa.int64()))],
                ["part", "label", "survivors"],
            )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic) for each document, narrow.

    The first of equal texts is the one of the smallest number. It is found by aggregation and marked by a join on
    the pair of text and number, which spreads copies. Equal texts are told by 128 bits.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.md5(text).alias("key"))
    rows = stored(rows.mapInArrow(_judged, "doc_id BIGINT, part STRING, key STRING, failed INT"), "judged")
    firsts = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(firsts, ["key", "doc_id"], "left")
    # Only a number can be larger than the smallest one.
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    failed = F.col("failed") + copied.cast("int") * (1 << FILTERS.index("E"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias(GOOD),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias(TOXIC),
    )
    marked = rows.select("doc_id", "part", failed.alias("failed")).join(marks, "doc_id", "left")
    is_ = lambda label: F.coalesce(label, F.lit(False)).alias(label)
    return marked.select("part", "failed", is_(GOOD), is_(TOXIC))


def survivors(rows: DataFrame) -> DataFrame:
    """(part, label, survivors): documents that survive each subset of the filters, by its number."""
    counts = rows.mapInArrow(_counted, "part STRING, label STRING, survivors ARRAY<BIGINT>")
    sums = [F.sum(F.get("survivors", F.lit(s))).alias(f"s{s}") for s in range(SUBSETS)]
    found = counts.groupBy("part", "label").agg(*sums)
    return found.select("part", "label", F.array(*(f"s{s}" for s in range(SUBSETS))).alias("survivors"))


def _steps() -> tuple[list, ...]:
    """Every step of every order: order, step, bit of its filter, and the subset applied before it."""
    steps = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append(("".join(order), step, bit, before))
            before |= bit
    return tuple(map(list, zip(*steps)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of documents.

    A null text is empty and fails A alone; a null language is the part of the empty string, as an
    empty one is. Repeated rows are separate documents; of rows with equal numbers and texts none is a copy of
    the other. A row without a number is no copy, and makes none of others. A number has a label if
    any of its label rows says so; labels without a document count nowhere. Very long texts are cut into
    words piece by piece. No documents give no rows. Other columns are ignored.
    """
    by_label = survivors(judged(docs, labels)).groupBy("part").agg(
        *(F.first(F.when(F.col("label") == label, F.col("survivors")), ignorenulls=True).alias(label) for label in (EVERY, GOOD, TOXIC))
    )
    names = ("filter_order", "step", "bit", "before")
    steps = F.explode(F.arrays_zip(*(F.lit(values).alias(name) for name, values in zip(names, _steps())))).alias("s")
    rows = by_label.select("part", EVERY, GOOD, TOXIC, steps).select("part", EVERY, GOOD, TOXIC, "s.*")
    bit, before, everything = F.col("bit"), F.col("before"), SUBSETS - 1
    after = before.bitwiseOR(bit)

    def lost(label: str):
        return F.get(label, before) - F.get(label, after)

    fails = F.get(EVERY, F.lit(0)) - F.get(EVERY, bit)
    alone = F.get(EVERY, F.lit(everything) - bit) - F.get(EVERY, F.lit(everything))
    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        F.get(EVERY, after).alias("kept"),
        lost(EVERY).alias("removed"),
        (fails - lost(EVERY)).alias("redundant"),
        alone.alias("unique_fails"),
        lost(GOOD).alias("good_lost"),
        lost(TOXIC).alias("toxic_lost"),
        F.sum(lost(EVERY)).over(Window.partitionBy("part", "bit")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {{'A': len(w) < {LEAST_WORDS}, 'B': 100 * len(list_distinct(w)) < {LEAST_DIFFERENT} * len(w),
      'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t),
      'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)}} AS f
  FROM w LEFT JOIN m USING (doc_id)),
g AS (
  SELECT part, good, toxic, [x for x in
    [CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END,
     CASE WHEN f.D THEN 'D' END, CASE WHEN f.E THEN 'E' END] if x IS NOT NULL] AS fails, count(*) AS n
  FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT o, step::INT AS step, o[step] AS x, o[1:step - 1] AS before FROM o, range(1, 6) r(step)),
c AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, x,
    sum(CASE WHEN NOT list_has_any(fails, before) AND NOT list_contains(fails, x) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = [x] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN good AND NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN toxic AND NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM c
"""
