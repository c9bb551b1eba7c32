"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

Each tree splits the space again and again at the median of a random projection. Vectors within the
spill margin of a split go to both sides, so a linked pair seldom parts; the margin is the deviation
that a pair at the threshold has along a random direction. Vectors are compared within the leaves
of every tree, exactly and in blocks, and what they link is joined to components.

The trees are fitted on the driver from a sample of at most ``SAMPLE`` vectors, and hold at most
``SAMPLE / LEAST`` splits each, so what is broadcast is bounded. All vectors are dealt into leaves.
Leaves that are still several times too large are split on in the same way, level by level, at medians
that Spark aggregates, so a leaf's size does not grow with the table. One that a split does not make
smaller, in which vectors are alike, is compared block by block in separate tasks. A pair that shares
several leaves counts in the first of them only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import grouped, hinted, in_blocks, read, stored
from repotide.llm.components import components

SIMILARITY = 0.98
TREES = 6
# Vectors of one label aimed at per leaf, the sample's bound, and its least number per leaf.
LEAF, SAMPLE, LEAST = 256, 16_384, 16
SPILL = 1.0
BLOCK = 1024
# A leaf of so many times the size aimed at is split on, as long as its halves hold less than this part of twice it.
OVERSIZE, USEFUL = 4, 0.85
SEED = 11

VECTOR = "vec_id BIGINT, label STRING, class BINARY, unit BINARY"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision. Equal vectors of one label and length are one class."""
    for batch in batches:
        ids, labels, keys, units = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))
        for vec_id, label, vector in zip(*columns):
            unit = None
            if label is not None and vector and None not in vector:
                raw = np.array(vector, np.float64)
                norm = np.linalg.norm(raw)
                if np.isfinite(norm) and norm > 0:
                    unit = raw / norm
            ids.append(vec_id)
            # Only vectors of one length can be compared.
            labels.append(None if unit is None else f"{len(unit)}:{label}")
            units.append(None if unit is None else unit.tobytes())
            keys.append(
                None
                if unit is None
                else hashlib.blake2b(raw.tobytes() + labels[-1].encode(), digest_size=16).digest()
            )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(labels, pa.string()),
                pa.array(keys, pa.binary()),
                pa.array(units, pa.binary()),
            ],
            ["vec_id", "label", "class", "unit"],
        )


def fit_forest(sample: np.ndarray, depth: int, trees: int, seed: int):
    """Directions and thresholds of ``trees`` complete trees: node k has the children 2k+1, 2k+2."""
    random = np.random.default_rng(seed)
    inner = 2**depth - 1
    directions = random.standard_normal((trees, inner, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True) if inner else 1
    thresholds = np.zeros((trees, inner))
    for tree in range(trees):
        node = np.zeros(len(sample), np.int64)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            if len(own):
                along = sample[own] @ directions[tree, k]
                thresholds[tree, k] = np.median(along)
                node[own] = 2 * k + 1 + (along > thresholds[tree, k])
    return directions, thresholds


def leaves(units: np.ndarray, directions: np.ndarray, thresholds: np.ndarray, depth: int, margin: float):
    """(row, leaf) of one tree; a row within the margin of a split goes both ways."""
    rows, nodes = np.arange(len(units)), np.zeros(len(units), np.int64)
    for _ in range(depth):
        along = np.einsum("ij,ij->i", units[rows], directions[nodes]) - thresholds[nodes]
        left, right = along <= margin, along >= -margin
        rows = np.concatenate([rows[left], rows[right]])
        nodes = np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
    return rows, nodes


def _deal(forests: dict, depth: int, margins: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("unit").to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, unit in enumerate(raw):
                by_size.setdefault(len(unit) // 8, []).append(i)
            for size, own in by_size.items():
                units = np.array([np.frombuffer(raw[i]) for i in own])
                codes: list[list[int]] = [[] for _ in own]
                if size in forests:
                    directions, thresholds = forests[size]
                    for tree in range(len(directions)):
                        placed = leaves(units, directions[tree], thresholds[tree], depth, margins[size])
                        for row, leaf in zip(*placed):
                            codes[row].append((tree << 32) + int(leaf))
                else:
                    # A length that the sample missed is rare: one leaf.
                    codes = [[0] for _ in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").take(own),
                        batch.column("class").take(own),
                        pa.array(codes, pa.list_(pa.int64())),
                    ],
                    ["label", "class", "leaves"],
                )

    return run


def _along(seed: int):
    """Members of leaves with their place along the direction of their leaf."""

    def drawn_for(leaf: int, size: int) -> np.ndarray:
        drawn = np.random.default_rng([seed, leaf % (1 << 64)]).standard_normal(size)
        return drawn / np.linalg.norm(drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        direction = lru_cache(1 << 12)(drawn_for)
        for batch in batches:
            units = (np.frombuffer(unit) for unit in batch.column("unit").to_pylist())
            leaves = batch.column("leaf").to_pylist()
            along = [float(unit @ direction(leaf, len(unit))) for unit, leaf in zip(units, leaves)]
            kept = {name: batch.column(name) for name in ("label", "class", "leaf")}
            margin = {"margin": batch.column("margin"), "along": pa.array(along, pa.float64())}
            yield pa.RecordBatch.from_pydict({**kept, **margin})

    return run


def _split_on(placed: DataFrame, classes: DataFrame, most: int, spread: float, seed: int) -> DataFrame:
    """``placed`` (label, class, leaves) with leaves of more than ``most`` members split at medians.

    ``spread`` divided by the root of a vector's length is the spill margin. A level goes over the members of
    leaves that are too large alone; each about halves them.
    """
    members = placed.select("label", "class", F.explode("leaves").alias("leaf"))
    sizes = stored(members.groupBy("label", "leaf").agg(F.count("*").alias("n")), "leaf_sizes")
    large = sizes.where(F.col("n") > most)
    if large.isEmpty():
        return placed
    group = ["label", "leaf"]
    done = [members.join(large, group, "left_anti").select("label", "class", "leaf")]
    open_ = stored(members.join(large, group).select("label", "class", "leaf", "n"), "large_leaves")
    units = classes.select("class", "unit", (spread / F.sqrt(F.octet_length("unit") / 8)).alias("margin"))
    while not open_.isEmpty():
        rows = open_.select("label", "class", "leaf").join(units, "class")
        rows = rows.mapInArrow(_along(seed), "label STRING, class BINARY, leaf BIGINT, margin DOUBLE, along DOUBLE")
        rows = stored(rows, "along")
        medians = rows.groupBy(*group).agg(F.percentile_approx("along", 0.5, 1000).alias("median"), F.count("*").alias("n"))
        apart = F.col("along") - F.col("median")
        side = lambda name, fits: F.when(fits, F.xxhash64("leaf", F.lit(name)))
        halves = F.array_compact(
            F.array(side("left", apart <= F.col("margin")), side("right", apart >= -F.col("margin")))
        )
        rows = rows.join(medians, group).select("label", "class", "leaf", "n", halves.alias("halves"))
        rows = stored(rows, "halves")
        grown = rows.groupBy(*group).agg((F.sum(F.size("halves")) / F.first("n") / 2).alias("part"))
        rows = rows.join(grown, group)
        # Vectors that no split tells apart stay in one leaf.
        done.append(rows.where(F.col("part") >= USEFUL).select("label", "class", "leaf"))
        split = rows.where(F.col("part") < USEFUL).select("label", "class", F.explode("halves").alias("leaf"))
        split = stored(split, "split")
        counted = split.join(split.groupBy(*group).agg(F.count("*").alias("n")), group)
        counted = stored(counted, "counted")
        done.append(counted.where(F.col("n") <= most).select("label", "class", "leaf"))
        open_ = counted.where(F.col("n") > most)
    everyone = reduce(DataFrame.unionByName, done)
    again = everyone.groupBy("class").agg(F.first("label").alias("label"), F.collect_list("leaf").alias("leaves"))
    return stored(again.select("label", "class", "leaves"), "leaves")


def _labels(linked: np.ndarray) -> np.ndarray:
    """The first row that each row of a symmetric link matrix is connected to."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(similarity: float):
    def block(low: list[dict], high: list[dict], code: int):
        """Of every member its links to the other block, and a member of its component."""
        members = low + high
        units = [np.array([np.frombuffer(r["unit"]) for r in side]) for side in (low, high)]
        earlier = [[c for c in r["leaves"] if c < code] for r in members]
        known = {c: i for i, c in enumerate({c for own in earlier for c in own})}
        before = np.zeros((len(members), len(known)), np.float32)
        for i, own in enumerate(earlier):
            before[i, [known[c] for c in own]] = 1
        copies = np.array([r["copies"] for r in members], np.int64)
        k = len(low)
        if high:
            linked = units[0] @ units[1].T >= similarity
            fresh = linked & ~((before[:k] @ before[k:].T) > 0)
            counts = np.concatenate([fresh @ copies[k:], fresh.T @ copies[:k]])
            both = np.zeros((len(members),) * 2, bool)
            both[:k, k:] = fresh
            both |= both.T
        else:
            linked = units[0] @ units[0].T >= similarity
            np.fill_diagonal(linked, False)
            both = linked & ~((before @ before.T) > 0)
            counts = both @ copies
        for i, root in enumerate(_labels(both)):
            if counts[i]:
                yield members[i]["class"], members[root]["class"], int(counts[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "task"):
            same = rows[0]["low"] == rows[0]["high"]
            low = [r for r in rows if r["side"] == r["low"]]
            high = [] if same else [r for r in rows if r["side"] == r["high"]]
            found = list(block(low, high, rows[0]["leaf"])) if low and (same or high) else []
            if found:
                a, b, n = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())],
                    ["a", "b", "n"],
                )

    return run


def linked_vectors(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    spill: float = SPILL,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """Rows (vec_id, embedding, label) with ``n_links``, ``component_id`` and ``kept``.

    Vectors link at a cosine of ``similarity`` or more and equal labels. Null, empty and zero vectors,
    those with null or non-finite components and those without a label link with nothing, nor do
    vectors of different lengths. Repeated rows are separate vectors that share a number. Rows
    without a number count as links of others; their component is the smallest number there is,
    and they are not kept unless it is null. No rows give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    rows = stored(rows.mapInArrow(_units, VECTOR), "units")
    valid = rows.where("class is not null")
    classes = stored(
        valid.groupBy("class").agg(
            F.min("vec_id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("label").alias("label"),
            F.first("unit").alias("unit"),
        ),
        "classes",
    )
    n, labels = classes.agg(F.count("*"), F.approx_count_distinct("label")).first()
    part = F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / max(1, n))))
    by_size: dict[int, list] = {}
    for row in classes.where(part).select("unit").limit(2 * sample).collect():
        by_size.setdefault(len(row["unit"]) // 8, []).append(np.frombuffer(row["unit"]))
    most = max([0, *map(len, by_size.values())])
    wanted = math.ceil(math.log2(max(1, n / (max(1, labels) * leaf))))
    depth = max(0, min(wanted, int(math.log2(max(1, most / LEAST)))))
    # The distance of two unit vectors at the threshold, seen along a random direction.
    margins = {size: spill * math.sqrt((2 - 2 * similarity) / size) for size in by_size}
    forests = {
        size: fit_forest(np.array(own), depth, trees if depth else 1, seed) for size, own in by_size.items()
    }
    forest = spark.sparkContext.broadcast(forests)

    def deal(batches):
        return _deal(forest.value, depth, margins)(batches)

    placed = classes.select("label", "class", "unit")
    placed = placed.mapInArrow(deal, "label STRING, class BINARY, leaves ARRAY<BIGINT>")
    spread = spill * math.sqrt(2 - 2 * similarity)
    placed = _split_on(stored(placed, "leaves"), classes, OVERSIZE * leaf, spread, seed)
    members = placed.select("label", "class", F.explode("leaves").alias("leaf"))
    sizes = members.groupBy("label", "leaf").agg(F.count("*").alias("n_members")).where("n_members > 1")
    dealt = in_blocks(members.join(sizes, ["label", "leaf"]), ["label", "leaf"], "class", block)
    dealt = dealt.select("class", "leaf", "side", "low", "high", "task")
    held = classes.select("class", "copies", "unit").join(placed.select("class", "leaves"), "class")
    tasks = dealt.join(held, "class").repartition("task").sortWithinPartitions("task")
    found = stored(tasks.mapInArrow(_compare(similarity), "a BINARY, b BINARY, n BIGINT"), "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "class")
    joined = components(found.select("a", "b")).withColumnRenamed("node", "class")
    known = classes.select("class", "rep", "copies").join(counts, "class", "left")
    known = known.join(joined, "class", "left")
    known = known.withColumn("component", F.coalesce("component", "class"))
    lowest = known.groupBy("component").agg(F.min("rep").alias("lowest"))
    # Stored on its own, so that a hot component can be split.
    known = stored(known.join(hinted(stored(lowest, "lowest")), "component"), "known")
    out = rows.select("vec_id", "class").join(known, "class", "left")
    n_links = F.coalesce(F.col("copies") - 1 + F.coalesce("n", F.lit(0)), F.lit(0))
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("lowest"))
    return out.select(
        "vec_id", n_links.cast("bigint").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_rp_forest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(read(spark, sf_dir, "embeddings"))


# All pairs of a label; for small tables.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
    AND len([c for c in embedding if c <> 0]) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT node, b FROM reach JOIN l ON other = a),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.node = vec_id LEFT JOIN n ON n.a = vec_id
"""
