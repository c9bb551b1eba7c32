"""Embedding links against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from repotide.llm import embeddings
from repotide.llm.common import Forest

ROWS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, class STRING"


def table(spark, vectors, labels):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], l, "c") for i, (v, l) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, ROWS).repartition(4)


def all_pairs(vectors, labels):
    units = {}
    for i, (v, l) in enumerate(zip(vectors, labels)):
        if v is not None and len(v) and l is not None and None not in list(v):
            x = np.array(v, np.float32).astype(float)
            if np.isfinite(x).all() and x.any():
                units[i] = x / np.linalg.norm(x)
    forest, links = Forest(len(vectors)), [0] * len(vectors)
    for i in units:
        for j in units:
            if i < j and labels[i] == labels[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98:
                forest.join(i, j)
                links[i] += 1
                links[j] += 1
    return links, [forest.root(i) for i in range(len(vectors))]


def clustered(n, size, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 12, size))
    spread = rng.choice([0.02, 0.15, 0.3], n)[:, None] / math.sqrt(size) * np.linalg.norm(centres, axis=1).mean()
    vectors = centres[rng.integers(0, len(centres), n)] + rng.standard_normal((n, size)) * spread
    return vectors.astype(np.float32), rng.integers(0, 2, n).tolist()


@pytest.mark.parametrize("how", [{}, {"leaf": 16, "block": 7}, {"leaf": 20, "sample": 300, "trees": 8}, {"leaf": 12, "sample": 40}])
def test_equals_all_pairs(spark, how):
    vectors, labels = clustered(900, 32)
    links, roots = all_pairs(vectors, labels)
    found = {r["vec_id"]: r for r in embeddings.linked_vectors(table(spark, vectors, labels), **how).collect()}
    assert len(found) == 900
    recalled = sum(found[i]["n_links"] for i in range(900))
    assert all(found[i]["n_links"] <= links[i] for i in range(900))
    assert recalled >= 0.99 * sum(links) > 1000
    if "leaf" not in how:
        assert [found[i]["n_links"] for i in range(900)] == links
        assert [found[i]["component_id"] for i in range(900)] == roots
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_oversized_leaves_are_split_on(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((1200, 24)).astype(np.float32)
    vectors[600:] = vectors[:600] + 0.02 * rng.standard_normal((600, 24)).astype(np.float32)
    # Many vectors that no split tells apart, in one leaf of their own.
    alike = vectors[:1] + 1e-4 * rng.standard_normal((150, 24)).astype(np.float32)
    vectors = np.concatenate([vectors, alike])
    rows = table(spark, vectors, [0] * len(vectors))
    units = embeddings.stored(rows.select("vec_id", F.lit("x").alias("label"), "embedding").mapInArrow(embeddings._units, embeddings.VECTOR), "units")
    classes = embeddings.stored(units.select("class", "label", "unit"), "classes")
    placed = embeddings.stored(classes.select("label", "class", F.array(F.lit(5).cast("bigint")).alias("leaves")), "leaves")
    spread = math.sqrt(2 - 2 * 0.98)
    split = embeddings._split_on(placed, classes, 100, spread, 3)
    assert split.count() == len(vectors)
    sizes = [r["n"] for r in split.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).collect()]
    # Leaves that hold the vectors no split tells apart stay a little larger.
    assert max(sizes) < 400 and sum(sizes) < 6 * len(vectors)
    held = {r["class"]: set(r["leaves"]) for r in split.collect()}
    by_id = {r["vec_id"]: r["class"] for r in units.collect()}
    met = sum(bool(held[by_id[i]] & held[by_id[600 + i]]) for i in range(600))
    assert met >= 0.95 * 600
    links, roots = all_pairs(vectors, [0] * len(vectors))
    found = {r["vec_id"]: r for r in embeddings.linked_vectors(rows, leaf=20, sample=48).collect()}
    assert sum(found[i]["n_links"] for i in found) >= 0.99 * sum(links)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    vectors = [v, v, v, None, [0, 0, 0], [1, None, 3], [float("nan"), 1, 1], [float("inf"), 1, 1], [], v[:2], [2, 4, 6], [1, 2], v]
    labels = [1, 1, None, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
    links, roots = all_pairs(vectors, labels)
    found = embeddings.linked_vectors(table(spark, vectors, labels)).orderBy("vec_id").collect()
    assert [r["n_links"] for r in found] == links == [2, 2, 0, 0, 0, 0, 0, 0, 0, 1, 2, 1, 0]
    assert [r["component_id"] for r in found] == roots


def test_no_number_repeats_and_no_rows(spark):
    rows = [(4, [1.0, 0.0], 1, "c")] * 3 + [(None, [1.0, 0.0], 1, "c"), (None, None, None, None)]
    found = embeddings.linked_vectors(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1) for r in found) == [
        (-1, 0, -1), (-1, 3, 4), (4, 3, 4), (4, 3, 4), (4, 3, 4)]
    assert embeddings.linked_vectors(spark.createDataFrame([], ROWS)).collect() == []


def test_spill_keeps_close_pairs_together():
    rng = np.random.default_rng(3)
    sample = rng.standard_normal((2000, 32))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    directions, thresholds = embeddings.fit_forest(sample, 5, 1, 1)
    shift = rng.standard_normal(sample.shape)
    shift -= (shift * sample).sum(1)[:, None] * sample
    shift /= np.linalg.norm(shift, axis=1)[:, None]
    near = 0.98 * sample + math.sqrt(1 - 0.98**2) * shift
    margin = math.sqrt(2 - 2 * 0.98) / math.sqrt(32)
    sides = [embeddings.leaves(x, directions[0], thresholds[0], 5, margin) for x in (sample, near)]
    met = set(zip(*map(np.ndarray.tolist, sides[0]))) & set(zip(*map(np.ndarray.tolist, sides[1])))
    assert len({row for row, _ in met}) >= 0.97 * len(sample)
    assert len(sides[0][0]) < 4 * len(sample)
