"""Centroids against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest

from repotide.llm import centroids

ROWS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster INT, distance STRING"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 7, "d") for i, x in rows], ROWS).repartition(3)


def plain(rows, clusters, rounds, size, scale, seed=centroids.SEED):
    """Sorted (vec_id, cluster, distance) and the last centroids, in whole Python numbers."""
    most = centroids.LARGEST
    fit = [(i, [max(-most, min(most, math.floor(c * scale))) for c in x]) for i, x in rows
           if x is not None and len(x) == size and all(c is not None and math.isfinite(c) for c in x)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in fit if i is not None)
    centres = [x for _, x in named[:clusters]]
    if not centres:
        return [], []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in fit]
        for j in range(len(centres)):
            members = [x for (_, x), k in zip(fit, own) if k == j]
            if members:
                centres[j] = [sum(c) // len(members) for c in zip(*members)]
    found = [(i, nearest(x)[1], nearest(x)[0]) for i, x in fit]
    return sorted(found, key=repr), centres


def made(n, size, groups, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size)) * 2
    return [(i, (centres[rng.integers(groups)] + 0.3 * rng.standard_normal(size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"block": 17}, {"clusters": 3, "rounds": 2}, {"rounds": 0}])
def test_equals_plain_rounds(spark, how):
    rows = made(400, 6, 9)
    found, centres, _ = centroids.clustered(table(spark, rows), size=6, scale=64, **how)
    want, last = plain(rows, how.get("clusters", 8), how.get("rounds", 10), 6, 64)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert centres.tolist() == last


def test_bounds_spare_distances_of_groups_that_lie_apart(spark):
    rows = made(1500, 8, 8)
    found, _, evaluated = centroids.clustered(table(spark, rows), size=8)
    want, _ = plain(rows, 8, 10, 8, 1024)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert evaluated[0] == 8 * 1500
    assert min(evaluated[1:]) < 1500 and sum(evaluated[1:]) < 0.5 * 8 * 1500 * len(evaluated[1:])


def test_a_bound_is_loosened_by_the_total_displacement():
    """A centroid that went out and came back has not moved since."""
    home = np.zeros((2, 3), np.int64)
    away = home + np.array([[300, 0, 0], [0, 40, 0]])
    moved = centroids.displacements([home, away, home + np.array([[0, 0, 4], [0, 0, 0]])])
    assert moved[0] == pytest.approx([4, 0], rel=1e-5)
    assert moved[1][0] == pytest.approx(math.hypot(300, 4), rel=1e-5)
    assert (moved[2] == 0).all()


def test_odd_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (4, None), (5, [1.0]),
            (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [None, 1.0]), (9, []), (10, [1e300, -1e300]), (11, [-0.4, 0.4])]
    for clusters in (2, 3, 8):
        found, centres, _ = centroids.clustered(table(spark, rows), clusters=clusters, size=2, scale=4)
        want, last = plain(rows, clusters, 10, 2, 4)
        got = sorted(map(tuple, found.collect()), key=repr)
        assert got == want and len(got) == 7
        assert centres.tolist() == last


def test_digests(spark):
    rows = made(50, 4, 3)
    found, centres, _ = centroids.clustered(table(spark, rows), clusters=3, size=4)
    out = centroids.with_digests(found, centres).collect()
    for row in out:
        own = centres[row["cluster"]].tolist()
        assert row["centroid_sha256"] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert row["cluster_inertia"] == sum(r["distance"] for r in out if r["cluster"] == row["cluster"])
        assert row["inertia"] == sum(r["distance"] for r in out)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0, 2.0])]])
def test_nothing_to_start_from(spark, rows):
    found, centres, _ = centroids.clustered(table(spark, rows), size=2)
    assert centroids.with_digests(found, centres).collect() == []


def test_older_blocks_are_removed(spark):
    import os

    from repotide.session import shared_dir

    def folders():
        return {name for name in os.listdir(shared_dir(spark)) if name.startswith("blocks-")}

    before = folders()
    centroids.clustered(table(spark, made(200, 4, 5)), size=4)
    assert len(folders() - before) == 1
