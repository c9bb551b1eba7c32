"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the multiset of its runs of five words; a run seen c times weighs 1 + ln(c). Two
documents are alike by probability Jaccard, the chance that a ProbMinHash component agrees:
sum over common elements i of 1 / sum_j max(x_j / x_i, y_j / y_i). With equal weights that is the
plain Jaccard similarity.

Steps: ``signatures`` (each element's arrivals are a Poisson process of its weight's rate over the
components, followed only while it can still win one), classes of equal word sequences, buckets of
classes with equal bands, ``links`` within buckets, and components.

A bucket's pairs are compared within tasks, in blocks, so a hot bucket is spread and no pair is ever
a row. A pair is looked at only in the first band it shares. It is verified exactly if enough of its
signature agrees and nothing in the task links it yet. Only links that join something are returned,
which is all that components need.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import (
    Forest,
    grouped,
    hinted,
    in_blocks,
    mixed,
    ragged,
    read,
    shingles,
    stored,
    text_key,
    word_hashes,
)
from repotide.llm.components import components

SIMILARITY = 0.8
# 16 bands of 4 find a pair of similarity 0.8 with probability 1 - (1 - 0.8**4)**16 = 0.9998.
BANDS, BAND_ROWS = 16, 4
# Pairs whose signatures agree in fewer components than the threshold less four standard
# deviations are not verified: at most 3 in 100,000 pairs at the threshold.
DEVIATIONS = 4
# Members of a bucket in one block; a task compares two blocks.
BLOCK = 1024
# Words handled at once within a task.
CHUNK_WORDS = 1 << 18

ROW = "doc_id BIGINT, text_id BIGINT, class BINARY, n_shingles INT, signature BINARY, bands ARRAY<BIGINT>"


def weighted(values: np.ndarray, offsets: np.ndarray):
    """Distinct shingles of each row, sorted, with weights: (hashes, weights, offsets)."""
    hashes, ends = shingles(values, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(hashes)))
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows[first], minlength=len(offsets) - 1))])
    return hashes[first], 1 + np.log(counts), ends


def signatures(hashes: np.ndarray, weights: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """The element that wins each of ``size`` components, per row; rows without elements get zeros.

    Each round draws the next arrival of every element that is still running. An element stops once
    its last arrival came after the latest winner of its row.
    """
    n = len(ends) - 1
    best = np.full(n * size, np.inf)
    winner = np.zeros(n * size, np.int32)
    rows = np.repeat(np.arange(n), np.diff(ends))
    hashes, rates, at = hashes.copy(), 1 / weights, np.zeros(len(hashes))
    state = hashes.copy()
    while len(state):
        state = mixed(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        at = at - np.log(u) * rates
        place = rows * size + (mixed(state) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, place, at)
        won = best[place] == at
        winner[place[won]] = hashes[won].astype(np.uint32).view(np.int32)
        on = at < best.reshape(n, size).max(axis=1)[rows]
        state, hashes, rates, at, rows = state[on], hashes[on], rates[on], at[on], rows[on]
    return winner.reshape(n, size)


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` values; a row is never cut."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def _classes(values: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = values.astype(np.int64).tobytes()
    return [
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest()
        for a, b in zip(offsets[:-1], offsets[1:])
    ]


def _sign(bands: int, band_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = ragged(batch.column("hashes"))
            for start, stop in _slices(offsets, CHUNK_WORDS):
                own = offsets[start : stop + 1]
                part, own = values[own[0] : own[-1]], own - own[0]
                hashes, weights, ends = weighted(part, own)
                signed = signatures(hashes, weights, ends, bands * band_rows)
                keys = np.zeros((stop - start, bands), np.uint64)
                for j in range(band_rows):
                    keys = mixed(keys + signed[:, j::band_rows].astype(np.uint64) + np.uint64(j + 1))
                keys = keys.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, stop - start) for c in ("doc_id", "text_id")),
                        pa.array(_classes(part, own), pa.binary()),
                        pa.array(np.diff(ends).astype(np.int32)),
                        pa.array([row.tobytes() for row in signed], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_id", "class", "n_shingles", "signature", "bands"],
                )

    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with their elements and weights."""
    for batch in batches:
        values, offsets = ragged(batch.column("hashes"))
        for start, stop in _slices(offsets, CHUNK_WORDS):
            own = offsets[start : stop + 1]
            part, own = values[own[0] : own[-1]], own - own[0]
            hashes, weights, ends = weighted(part, own)
            spans = list(zip(ends[:-1], ends[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_classes(part, own), pa.binary()),
                    pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([weights[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                ["class", "elements", "weights"],
            )


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets (sorted elements, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][i], b[1][j]
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    # Elements of a alone count by x, those of b alone by y; a common one counts by x for the
    # elements of smaller ratio x / y and by y for those of larger ratio.
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    above = np.cumsum(x[::-1])[::-1]
    below = np.cumsum(y) - y
    return float(np.sum(1 / ((only_x + above) / x + (only_y + below) / y)))


def _compare(similarity: float, enough: int):
    def pairs(low: list[dict], high: list[dict], same: bool) -> Iterator[tuple[bytes, bytes]]:
        everyone = low if same else low + high
        first, n = (0, len(low)) if same else (len(low), len(high))
        signed = np.array([np.frombuffer(r["signature"], np.int32) for r in everyone])
        bands = np.array([r["bands"] for r in everyone])
        band = everyone[0]["band"]
        sets = [
            (np.frombuffer(r["elements"], np.uint64), np.frombuffer(r["weights"])) for r in everyone
        ]
        plain = [None] * len(everyone)

        def unit(k: int) -> frozenset | None:
            if plain[k] is None:
                elements, weights = sets[k]
                plain[k] = frozenset(elements.tolist()) if weights.max() == 1 else False
            return plain[k]

        def alike(i: int, j: int) -> bool:
            a, b = unit(i), unit(j)
            if a and b:
                both = len(a & b)
                return both >= similarity * (len(a) + len(b) - both)
            return probability_jaccard(sets[i], sets[j]) >= similarity

        forest = Forest(len(everyone))
        for i in range(len(low)):
            start = max(first, i + 1) if same else first
            if start >= first + n:
                continue
            others = slice(start, first + n)
            agree = (signed[others] == signed[i]).sum(axis=1)
            fresh = ~(bands[others, :band] == bands[i, :band]).any(axis=1)
            found = np.flatnonzero((agree >= enough) & fresh)
            for j in found[np.argsort(-agree[found], kind="stable")]:
                j = int(j) + start
                if forest.root(i) != forest.root(j) and alike(i, j):
                    forest.join(i, j)
                    yield everyone[i]["class"], everyone[j]["class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "task"):
            same = rows[0]["low"] == rows[0]["high"]
            low = [r for r in rows if r["side"] == r["low"]]
            high = [] if same else [r for r in rows if r["side"] == r["high"]]
            found = list(pairs(low, high, same)) if low and (same or high) else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"]
                )

    return run


def links(rows: DataFrame, signed: DataFrame, similarity: float, bands: int, band_rows: int, block: int):
    """Links between classes: enough of them that what is linked by any pair is linked by these."""
    classes = signed.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    classes = stored(classes.where("rep is not null"), "classes")
    keyed = classes.select("class", F.posexplode("bands").alias("band", "key"))
    # Buckets with the same members are compared once, under their first band.
    buckets = (
        keyed.groupBy("band", "key")
        .agg(F.count("*").alias("n_members"), F.bit_xor(F.xxhash64("class")).alias("who"))
        .where("n_members > 1")
        .groupBy("n_members", "who")
        .agg(F.min(F.struct("band", "key")).alias("bucket"))
        .select("bucket.*", "n_members")
    )
    members = stored(keyed.join(buckets, ["band", "key"]), "members")
    needed = stored(members.select("class").distinct().join(classes, "class"), "needed")
    wanted = stored(needed.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    found = rows.join(hinted(wanted), "doc_id", "left_semi")
    sets = found.select("hashes").mapInArrow(_weigh, "class BINARY, elements BINARY, weights BINARY")
    # Copies and other texts under the same number: only the needed classes, each once.
    sets = sets.join(needed, "class").groupBy("class").agg(
        F.first("elements").alias("elements"),
        F.first("weights").alias("weights"),
        F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    sets = stored(sets, "sets")
    dealt = in_blocks(members, ["band", "key"], "class", block)
    dealt = dealt.select("class", "band", "side", "low", "high", "task")
    tasks = dealt.join(sets, "class").repartition("task").sortWithinPartitions("task")
    size = bands * band_rows
    spread = DEVIATIONS * math.sqrt(similarity * (1 - similarity) / size)
    enough = max(1, math.floor(size * (similarity - spread)))
    return tasks.mapInArrow(_compare(similarity, enough), "a BINARY, b BINARY")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: ``class_id``, ``cluster_id``, ``n_shingles`` and ``kept``.

    ``class_id`` is the smallest number among documents with the same words, ``cluster_id`` the
    smallest among those linked to it, over any number of links, at ``similarity`` or above;
    ``kept`` marks the document of that number. Texts without words (null, empty, only signs) are
    like nothing and are kept, as are rows without a number, whose identifiers are null. Rows equal
    in number and text are one document and get the same values; of other rows with one number
    the text of the lowest hash, ``text_id``, comes first. A very long text is signed whole, in memory of a
    few times its size. Other columns are ignored; no rows give
    no rows.
    """
    rows = docs.select("doc_id", text_key(docs).alias("text_id"), word_hashes(F.col("text")).alias("hashes"))
    signed = stored(rows.mapInArrow(_sign(bands, band_rows), ROW), "signed")
    found = components(links(rows, signed, similarity, bands, band_rows, block))
    own = F.struct("doc_id", "text_id")
    known = signed.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("class").agg(F.min(own).alias("class_first"))
    placed = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    lowest = placed.groupBy("component").agg(F.min("class_first").alias("first"))
    # Stored on its own, so that a hot component can be split.
    lowest = hinted(stored(lowest, "lowest"))
    placed = stored(placed.join(lowest, "component").select("class", "class_first", "first"), "placed")
    out = signed.select("doc_id", "text_id", "class", "n_shingles").join(hinted(placed), "class", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    ids = {"class_id": "class_first.doc_id", "cluster_id": "first.doc_id"}
    ids = [F.when(alone, F.col("doc_id")).otherwise(F.col(c)).alias(name) for name, c in ids.items()]
    kept = F.coalesce(alone | (own == F.col("first")), F.lit(False))
    return out.select("doc_id", *ids, "n_shingles", kept.alias("kept"), "text_id")


def op6_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("text_id")


# All pairs that share a shingle, by plain grouping; slow beyond small tables.
SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, [x for x in
    regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}]+') if x <> ''] AS w
  FROM documents),
c AS (SELECT w, min(doc_id) AS class_id FROM d WHERE len(w) > 0 GROUP BY w),
g AS (
  SELECT class_id, CASE WHEN len(w) < 5 THEN [w]
    ELSE [w[i:i + 4] for i in range(1, len(w) - 3)] END AS shingles FROM c),
e AS (
  SELECT class_id, s, 1 + ln(count(*)) AS x FROM (SELECT class_id, unnest(shingles) AS s FROM g)
  GROUP BY class_id, s),
n AS (SELECT class_id, sum(x) AS total FROM e GROUP BY class_id),
k AS (
  SELECT a.class_id AS a, b.class_id AS b, a.x AS x, b.x AS y
  FROM e a JOIN e b ON a.s = b.s AND a.class_id < b.class_id),
t AS (SELECT a, b, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM k GROUP BY a, b),
f AS (
  SELECT t.* , na.total AS ta, nb.total AS tb FROM t JOIN n na ON na.class_id = a JOIN n nb ON nb.class_id = b
  WHERE least(sx, sy) >= 0.5 * least(ta, tb)),
r AS (
  SELECT a, b, x, y, ta - sx AS ox, tb - sy AS oy,
    sum(x) OVER (PARTITION BY a, b ORDER BY x / y DESC) AS above,
    coalesce(sum(y) OVER (PARTITION BY a, b ORDER BY x / y
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
      - sum(y) OVER (PARTITION BY a, b, x / y) AS below
  FROM k JOIN f USING (a, b)),
l AS (
  SELECT a, b FROM r GROUP BY a, b
  HAVING sum(1 / ((ox + above) / x + (oy + below) / y)) >= 0.8),
pairs AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (
  SELECT a AS node, a AS other FROM pairs UNION SELECT node, b FROM reach JOIN pairs ON other = a),
p AS (SELECT node AS class_id, min(other) AS cluster_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
  coalesce(p.cluster_id, c.class_id, d.doc_id) AS cluster_id,
  coalesce((SELECT count(*) FROM e WHERE e.class_id = c.class_id), 0)::INT AS n_shingles,
  doc_id = coalesce(p.cluster_id, c.class_id, d.doc_id) AS kept
FROM d LEFT JOIN c ON d.w = c.w LEFT JOIN p ON p.class_id = c.class_id
"""
