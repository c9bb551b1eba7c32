"""Centroids of vectors by Lloyd's rounds, with ns-bounds that spare most distances.

Every vector keeps an upper bound on the distance to its centroid and a lower bound on the distance
to every centroid, each as it was when it was last evaluated, with the round of that evaluation. The
centroids of all rounds are kept. A bound is loosened by the norm of the total displacement of its
centroid since that round, which is never more than the sum of the drifts of the rounds between. A
centroid whose loosened lower bound is above the vector's upper bound can't be nearest, not even tied.
Where that fails, first the vector's own distance is evaluated, then those that still fail, exactly
and in integers, so every assignment is that of a full scan.

Vectors are written in blocks, with their bounds and the sums per centroid that they add up to beside
them. A round reads a block, moves its vectors, corrects its sums by the vectors that moved, and writes
it again; there is no shuffle of vectors. Only sums and counts of centroids reach the driver, their
number does not depend on the rows. The blocks of the round before are removed after that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import ragged, read
from repotide.session import remove_folder, run_dir

CLUSTERS, ROUNDS, SIZE, SCALE, SEED = 8, 10, 64, 1024, 3
# Vectors of a block, which is one row.
BLOCK = 1024
# Components are held within this, so that a squared distance fits a long.
LARGEST = 1 << 27
# Up to this, products of components add up exactly in doubles.
EXACT = 1 << 22
# What a stored bound may be off by, relative to itself: it is rounded to single precision.
SLACK = 1e-6

STATE = (
    "ids ARRAY<BIGINT>, x BINARY, cluster BINARY, upper BINARY, upper_at BINARY, lower BINARY, "
    "lower_at BINARY, sums ARRAY<BIGINT>, counts ARRAY<BIGINT>, evaluated BIGINT"
)
FOUND = "vec_id BIGINT, cluster INT, distance BIGINT"


def _finite(x: Column) -> Column:
    # NaN is above every number.
    return F.coalesce(F.abs(x) < float("inf"), F.lit(False))


def whole_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): vectors of ``size`` finite components, as whole numbers floor(scale * component)."""
    x = F.col("embedding").cast("array<double>")
    fit = (F.size(x) == size) & F.forall(x, _finite)
    held = lambda c: F.least(F.greatest(F.floor(c * scale), F.lit(-LARGEST)), F.lit(LARGEST))
    # A product beyond all doubles is held within the bounds before it is made a whole number.
    near = lambda c: F.least(F.greatest(c, F.lit(-1e9)), F.lit(1e9))
    return vectors.where(fit).select("vec_id", F.transform(x, lambda c: held(near(c)).cast("int")).alias("x"))


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose numbers have the smallest digests, in their order; null numbers start none.

    Vectors with one number follow each other by their components.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.where("vec_id IS NOT NULL").select("x").orderBy(digest, "x").limit(clusters).collect()
    return np.array([row["x"] for row in rows], np.int64)


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to one centroid."""
    apart = x - centroid
    if len(x) and np.abs(apart).max() <= EXACT:
        apart = apart.astype(np.float64)
    return np.einsum("ij,ij->i", apart, apart).astype(np.int64)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """[round, centroid]: how far the newest centroid is from that of the round, rounded up."""
    moved = [(past - history[-1]).astype(np.float64) for past in history]
    return np.linalg.norm(np.array(moved), axis=2) * (1 + SLACK)


def _above(squares: np.ndarray) -> np.ndarray:
    return (np.sqrt(squares.astype(np.float64)) * (1 + SLACK)).astype(np.float32)


def _below(squares: np.ndarray) -> np.ndarray:
    return (np.sqrt(squares.astype(np.float64)) * (1 - SLACK)).astype(np.float32)


def settle(x: np.ndarray, state: dict[str, np.ndarray], history: list[np.ndarray]) -> int:
    """Assign the vectors to the newest centroids, in place; returns the number of distances evaluated.

    ``state`` holds cluster, upper and upper_at per vector, lower and lower_at per vector and centroid.
    """
    now, centroids = len(history) - 1, history[-1]
    own = state["cluster"].astype(np.int64)
    moved = displacements(history)
    upper = state["upper"] + moved[state["upper_at"], own]
    lower = state["lower"] - np.take_along_axis(moved, state["lower_at"].astype(np.int64), axis=0)
    lower[np.arange(len(x)), own] = np.inf
    failed = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    evaluated = len(failed)
    best = np.zeros(len(x), np.int64)
    for j in np.unique(own[failed]):
        rows = failed[own[failed] == j]
        best[rows] = squared(x[rows], centroids[j])
        state["lower"][rows, j], state["lower_at"][rows, j] = _below(best[rows]), now
    state["upper"][failed], state["upper_at"][failed] = _above(best[failed]), now
    open_ = np.zeros(lower.shape, bool)
    open_[failed] = lower[failed] <= state["upper"][failed, None]
    for j in range(len(centroids)):
        rows = np.flatnonzero(open_[:, j])
        if not len(rows):
            continue
        evaluated += len(rows)
        found = squared(x[rows], centroids[j])
        state["lower"][rows, j], state["lower_at"][rows, j] = _below(found), now
        nearer = (found < best[rows]) | ((found == best[rows]) & (j < state["cluster"][rows]))
        rows, found = rows[nearer], found[nearer]
        best[rows], state["cluster"][rows] = found, j
        state["upper"][rows] = _above(found)
    return evaluated


def _sums(x: np.ndarray, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros((clusters, x.shape[1]), np.int64)
    for j in np.unique(cluster):
        sums[j] = x[cluster == j].sum(axis=0)
    return sums, np.bincount(cluster, minlength=clusters)


def _begin(centroids: np.ndarray, block: int):
    """Blocks of the vectors, with all distances to the first centroids evaluated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, _ = ragged(batch.column("x"))
            whole = values.astype(np.int32).reshape(batch.num_rows, -1)
            for start in range(0, batch.num_rows, block):
                x = whole[start : start + block]
                squares = np.stack([squared(x.astype(np.int64), c) for c in centroids], axis=1)
                # The first of equally near ones.
                cluster = squares.argmin(axis=1)
                nearest = squares[np.arange(len(x)), cluster]
                state = {
                    "cluster": cluster.astype(np.uint8),
                    "upper": _above(nearest),
                    "upper_at": np.zeros(len(x), np.uint8),
                    "lower": _below(squares),
                    "lower_at": np.zeros(squares.shape, np.uint8),
                }
                ids = batch.column("vec_id").slice(start, len(x)).to_pylist()
                sums, counts = _sums(x.astype(np.int64), cluster, len(centroids))
                yield _block(ids, x, state, sums, counts, squares.size)

    return run


def _block(ids, x, state, sums, counts, evaluated) -> pa.RecordBatch:
    columns = {
        "ids": pa.array([ids], pa.list_(pa.int64())),
        "x": pa.array([x.tobytes()], pa.binary()),
        **{name: pa.array([state[name].tobytes()], pa.binary()) for name in state},
        "sums": pa.array([sums.ravel().tolist()], pa.list_(pa.int64())),
        "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
        "evaluated": pa.array([int(evaluated)], pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _whole(row: dict) -> np.ndarray:
    return np.frombuffer(row["x"], np.int32).reshape(len(row["ids"]), -1).astype(np.int64)


def _unpacked(row: dict, clusters: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    kinds = {"cluster": np.uint8, "upper": np.float32, "upper_at": np.uint8, "lower": np.float32, "lower_at": np.uint8}
    state = {name: np.frombuffer(row[name], kind).copy() for name, kind in kinds.items()}
    for name in ("lower", "lower_at"):
        state[name] = state[name].reshape(-1, clusters)
    return _whole(row), state


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _again(history: list[np.ndarray]):
    """The blocks after one more assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters = len(history[-1])
        for row in _rows(batches):
            x, state = _unpacked(row, clusters)
            before = state["cluster"].copy()
            evaluated = settle(x, state, history)
            sums, counts = np.array(row["sums"]).reshape(clusters, -1), np.array(row["counts"])
            moved = np.flatnonzero(before != state["cluster"])
            if len(moved):
                left, fewer = _sums(x[moved], before[moved], clusters)
                joined, more = _sums(x[moved], state["cluster"][moved], clusters)
                sums, counts = sums + joined - left, counts + more - fewer
            yield _block(row["ids"], x.astype(np.int32), state, sums, counts, evaluated)

    return run


def _finish(centroids: np.ndarray):
    """(vec_id, cluster, distance) of the vectors in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            x, cluster = _whole(row), np.frombuffer(row["cluster"], np.uint8)
            distance = np.zeros(len(x), np.int64)
            for j in np.unique(cluster):
                distance[cluster == j] = squared(x[cluster == j], centroids[j])
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": pa.array(row["ids"], pa.int64()),
                    "cluster": pa.array(cluster, pa.int32()),
                    "distance": pa.array(distance, pa.int64()),
                }
            )

    return run


def _written(blocks: DataFrame) -> tuple[str, DataFrame]:
    """Rows are large, so few of them make a row group, which is read at once."""
    path = run_dir(blocks.sparkSession, "blocks")
    blocks.write.option("parquet.block.size", str(16 << 20)).parquet(path)
    return path, blocks.sparkSession.read.schema(STATE).parquet(path)


def _totals(blocks: DataFrame, column: str) -> list[int]:
    """The sums of an array column, place by place; whole numbers of any size."""
    places = blocks.select(F.posexplode(column).alias("place", "value"))
    rows = places.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    return [int(row["total"]) for row in sorted(rows, key=lambda row: row["place"])]


def _next(centroids: np.ndarray, blocks: DataFrame) -> np.ndarray:
    """The floors of the means; a centroid without vectors stays."""
    counts = _totals(blocks, "counts")
    sums = _totals(blocks, "sums")
    size = centroids.shape[1]
    moved = centroids.copy()
    for j, n in enumerate(counts):
        if n:
            moved[j] = [total // n for total in sums[j * size : (j + 1) * size]]
    return moved


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: int = SEED,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance) per vector, the last centroids, and the distances evaluated per pass.

    Vectors that are null, of another length, or hold null or non-finite components have no row.
    Repeated rows are separate vectors; a vector without a number is clustered, but starts no centroid.
    With fewer vectors than ``clusters`` (at most 256) there are as many centroids as vectors with
    numbers, and no rows if there is none. Components beyond 2**27 after scaling count as that. Equally
    near centroids: the first. Rounds after which nothing moves are not run, as they would change
    nothing. Other columns are ignored.
    """
    if not 0 < clusters <= 256 or rounds > 255:
        raise ValueError("clusters and rounds are held in a byte each")
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, size, scale)
    history = [first_centroids(whole, clusters, seed)]
    if not len(history[0]):
        return spark.createDataFrame([], FOUND), history[0], []

    path, blocks = _written(whole.mapInArrow(_begin(history[0], block), STATE))
    evaluated = [blocks.agg(F.sum("evaluated")).first()[0]]
    for _ in range(rounds):
        moved = _next(history[-1], blocks)
        if (moved == history[-1]).all():
            break
        history.append(moved)
        before = path
        path, blocks = _written(blocks.mapInArrow(_again(history), STATE))
        evaluated.append(blocks.agg(F.sum("evaluated")).first()[0])
        remove_folder(spark, before)
    found = blocks.select("ids", "x", "cluster").mapInArrow(_finish(history[-1]), FOUND)
    return found, history[-1], evaluated


def with_digests(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with the inertia of its cluster and of all, and the digest of its centroid."""
    if not len(centroids):
        return found.select(
            "*",
            F.lit(0).cast("bigint").alias("cluster_inertia"),
            F.lit(0).cast("bigint").alias("inertia"),
            F.lit("").alias("centroid_sha256"),
        )
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # One row per cluster; null where a sum does not fit a long.
    rows = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    sums = {row["cluster"]: int(row["total"]) for row in rows}
    fits = lambda total: total if total < 1 << 63 else None
    own = F.lit([fits(sums.get(j, 0)) for j in range(len(centroids))]).cast("array<bigint>")
    return found.select(
        "*",
        F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(fits(sum(sums.values()))).cast("bigint").alias("inertia"),
        F.get(F.lit(digests), F.col("cluster")).alias("centroid_sha256"),
    )


def op11_ns_bounds_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids, _ = clustered(read(spark, sf_dir, "embeddings"))
    return with_digests(found, centroids)


def _sql_rounds() -> str:
    assign = """
a{t} AS MATERIALIZED (
  SELECT r, vec_id, x, d[1] AS distance, d[2] AS cluster FROM (
    SELECT v.r, v.vec_id, v.x, min([list_sum([(v.x[i] - c.x[i]) * (v.x[i] - c.x[i]) for i in range(1, 65)])::BIGINT,
      c.cluster]) AS d
    FROM v, c{t} c GROUP BY ALL))"""
    move = """
s{t} AS (
  SELECT cluster, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM a{p}, range(1, 65) g(i) GROUP BY ALL),
c{t} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{p} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{t} GROUP BY cluster) m
    USING (cluster))"""
    steps = [assign.format(t=0)]
    for t in range(1, ROUNDS + 1):
        steps += [move.format(t=t, p=t - 1), assign.format(t=t)]
    return ",".join(steps)


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * e::DOUBLE)::BIGINT for e in embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {SIZE} AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), x) - 1 AS cluster, x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), x) <= {CLUSTERS}),
{_sql_rounds()}
SELECT vec_id, cluster::INT AS cluster, distance,
  sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)
"""
