"""Top scores against all pairs."""

import math

import numpy as np
import pytest

from repotide.llm import pivots

ROWS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, score STRING, row INT"


def table(spark, rows):
    return spark.createDataFrame([(i, x, "s", 1) for i, x in rows], ROWS).repartition(3)


def plain(rows, best=5, every=50, scale=256):
    fit = []
    for i, x in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            most = math.floor(math.sqrt(float(1 << 62) / max(4, len(x))))
            fit.append((i, [max(-most, min(most, math.floor(c * scale))) for c in x]))
    out = []
    for a, (i, q) in enumerate(fit):
        if i is not None and i % every == 0:
            others = [(-sum(map(lambda c, d: c * d, q, x)), j is None, j) for b, (j, x) in enumerate(fit) if a != b and len(x) == len(q)]
            others.sort(key=lambda o: (o[0], o[1], o[2] or 0))
            out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(others[:best], 1)]
    return sorted(out, key=repr)


def found(spark, rows, **how):
    return sorted(map(tuple, pivots.top_scores(table(spark, rows), **how).collect()), key=repr)


def made(n, size, groups, spread, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return [(i, (centres[rng.integers(groups)] + spread * rng.standard_normal(size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"annulus": 40}, {"annulus": 30, "shelf": 11, "annuli": 6, "pivots": 4}, {"sample": 20, "annulus": 25}])
def test_equals_all_pairs(spark, how):
    rows = made(600, 12, 9, 0.2)
    assert found(spark, rows, every=10, **how) == plain(rows, every=10)


def test_bounds_leave_out_most_of_what_lies_apart(spark):
    rows, steps = made(2000, 16, 20, 0.03), []
    assert found(spark, rows, annulus=25, steps=steps) == plain(rows)
    total = pivots.top_scores(table(spark, rows), annulus=25, best=2000, steps=(every := []))
    assert total.count() == 40 * 1999
    # Asking for all vectors leaves nothing out; asking for five scans a small part.
    assert steps[0] == 40 and sum(steps) < 0.25 * sum(every)


def test_equal_vectors_over_many_shelves(spark):
    rows = [(i, [1.0, 0.5]) for i in range(300)] + [(300 + i, [0.01 * i, 1.0]) for i in range(100)]
    assert found(spark, rows, annulus=20, shelf=16, every=25) == plain(rows, every=25)


def test_odd_vectors_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25, 1.0]
    rows = [(0, v), (0, v), (50, v), (51, v), (None, v), (None, [9.0, 9.0, 9.0]), (100, None), (150, [nan, 0.0, 0.0]), (200, [inf, 1.0, 1.0]),
            (250, [None, 1.0, 1.0]), (300, []), (350, []), (1, []), (400, [2.0]), (450, [1e300, -1e300, 1.0]), (3, [-1e12, 1e12, 0.0]), (-50, v)]
    assert found(spark, rows) == plain(rows)
    # Lengths that the sample missed have no pivots.
    assert found(spark, rows, sample=1) == plain(rows)


def test_few_and_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(7, [1.0]), (8, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (8, [-1.0])]) == [(0, 1, 8, -65536)]


def test_large_products_are_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19) + 3 * i)]) for i in range(0, 60, 2)]
    assert found(spark, rows, every=10) == plain(rows, every=10)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-90, 90, (500, 6)).astype(float), rng.integers(-90, 90, (40, 6)).astype(float)
    own = pivots.fit_pivots(x, 5, 3)
    away = pivots._apart(x, own)
    pivot = away.argmin(axis=1)
    distance = away[np.arange(len(x)), pivot]
    cells = [(p, a) for p in range(5) for a in range(4)]
    members = [np.flatnonzero((pivot == p) & (distance // 30 == a)) for p, a in cells]
    full = [(c, m) for c, m in zip(cells, members) if len(m)]
    listed = {
        "pivot": np.array([p for (p, _), _ in full]),
        "near": np.array([distance[m].min() for _, m in full]),
        "far": np.array([distance[m].max() for _, m in full]),
        "largest": np.array([(x[m] ** 2).sum(axis=1).max() for _, m in full]),
    }
    bounds = pivots._bounds(q, (q**2).sum(axis=1), own, listed)
    for j, (_, m) in enumerate(full):
        assert ((q @ x[m].T).max(axis=1) <= bounds[:, j]).all()
