"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and the distance to it. The vectors of a pivot fall into
annuli, ranges of that distance with about as many vectors each. With d(q, p) the distance of a query
to a pivot, no vector of an annulus from ``near`` to ``far`` is closer to the query than d(q, p) - far
or near - d(q, p), and as 2 q.x = |q|^2 + |x|^2 - |q - x|^2, this bounds its scores from above. The annuli
are sorted by that bound. A query first scans the annulus it lies in, then the few best, then all that
are left whose bound is not below the k-th best score found so far; where none is, it stops.

Pivots are fitted on a bounded sample (``SAMPLE`` vectors, ``COMPONENTS`` components), every vector is indexed. The table of annuli, at most ``PIVOTS``
times ``ANNULI`` per vector length in the sample, is broadcast. An annulus with more than ``SHELF`` vectors falls
into shelves, so that many equal vectors are spread; more than ``ASKERS`` queries at a shelf into parts. A
task holds one shelf, and queries stream past it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import read, stored

BEST, EVERY, SCALE = 5, 50, 256
# The most pivots and annuli of a pivot, the sample of a vector length, and vectors aimed at in an annulus.
PIVOTS, ANNULI, SAMPLE, ANNULUS = 256, 256, 16_384, 4_096
SHELF = 16_384
ASKERS = 1 << 20
# Annuli that a query scans in the second step; the first scans its own, the third all that are left.
NEXT = 4
SEED = 7
# Queries compared with a shelf at once, and bounds worked out at once.
TOGETHER, CELLS = 512, 1 << 20
# Components of the sample, which the driver holds.
COMPONENTS = 1 << 21
# Distances are doubles; bounds on scores give way by this part.
SLACK = 1e-9

HELD = "row BIGINT, vec_id BIGINT, n INT, x BINARY, square DOUBLE, pivot INT, distance DOUBLE"
FOUND = "query BIGINT, row BIGINT, vec_id BIGINT, score BIGINT"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, n, x): finite vectors as whole numbers floor(scale * component); ``row`` tells rows apart.

    Components are held within bounds that let an inner product fit a long.
    """
    x = F.col("embedding").cast("array<double>")
    fit = x.isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    n = F.size(x)
    most = F.floor(F.sqrt(F.lit(float(1 << 62)) / F.greatest(n, F.lit(4)))).cast("double")
    held = lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c * scale, -most), most)), F.ceil(-most)), F.floor(most))
    rows = vectors.select("vec_id", F.monotonically_increasing_id().alias("row"), "embedding").where(fit)
    return rows.select("row", "vec_id", n.alias("n"), F.transform(x, lambda c: held(c).cast("int")).alias("x"))


def fit_pivots(sample: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` pivots: the first at random, each next one the vector farthest from those before."""
    pivots = [sample[np.random.default_rng(seed).integers(len(sample))]]
    away = ((sample - pivots[0]) ** 2).sum(axis=1)
    while len(pivots) < n and away.max() > 0:
        pivots.append(sample[away.argmax()])
        away = np.minimum(away, ((sample - pivots[-1]) ** 2).sum(axis=1))
    return np.array(pivots)


def _apart(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors to pivots, good to doubles."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _keyed(pivots: dict[int, np.ndarray]):
    """Vectors with their nearest pivot; those of a length the sample missed have pivot -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy(zero_copy_only=False)
            for n in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                column = part.column("x")
                x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, n)
                if n in pivots:
                    apart = _apart(x, pivots[n])
                    pivot = apart.argmin(axis=1)
                    distance = apart[np.arange(len(x)), pivot]
                else:
                    pivot, distance = np.full(len(x), -1), np.zeros(len(x))
                whole = x.astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": part.column("row"),
                        "vec_id": part.column("vec_id"),
                        "n": part.column("n"),
                        "x": pa.array([v.tobytes() for v in whole], pa.binary()),
                        "square": pa.array((x**2).sum(axis=1), pa.float64()),
                        "pivot": pa.array(pivot, pa.int32()),
                        "distance": pa.array(distance, pa.float64()),
                    }
                )

    return run


def _index(
    whole: DataFrame, sample: int, pivots: int, annulus: int, annuli: int, shelf: int, seed: int
) -> tuple[DataFrame, DataFrame, dict[int, np.ndarray]]:
    """Vectors with their annulus and shelf, the table of annuli, and the pivots by vector length."""
    spark = whole.sparkSession
    total, longest = whole.agg(F.count("*"), F.max("n")).first()
    sample = max(1, min(sample, COMPONENTS // max(1, longest)))
    taken = whole.select("n", "x").orderBy(F.xxhash64("x", F.lit(seed)), "row").limit(sample).collect()
    by_size: dict[int, list] = {}
    for row in taken:
        by_size.setdefault(row["n"], []).append(row["x"])
    fitted = {}
    for n, own in by_size.items():
        # A pivot for every four annuli, as far as the sample tells.
        wanted = math.ceil(total * len(own) / len(taken) / (4 * annulus))
        fitted[n] = fit_pivots(np.array(own, np.float64).reshape(len(own), n), min(pivots, wanted), seed)
    held = stored(whole.mapInArrow(_keyed(fitted), HELD), "held")
    # Edges of about equally full annuli.
    parts = F.least(F.ceil(F.count("*") / annulus), F.lit(annuli)).alias("parts")
    full = F.percentile_approx("distance", [i / annuli for i in range(1, annuli)], 10 * annuli).alias("all")
    edges = held.where("pivot >= 0").groupBy("n", "pivot").agg(parts, full)
    pick = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda i: F.get("all", (i * annuli / F.col("parts")).cast("int") - 1))
    edges = edges.select("n", "pivot", F.when(F.col("parts") > 1, F.array_distinct(pick)).otherwise(F.array()).alias("edges"))
    edges = stored(edges, "edges")
    # At most one row per pivot: bounded.
    placed = held.join(F.broadcast(edges), ["n", "pivot"], "left")
    beyond = F.size(F.filter("edges", lambda e: e <= F.col("distance")))
    placed = placed.withColumn("annulus", F.coalesce(beyond, F.lit(0))).drop("edges")
    directory = stored(
        placed.groupBy("n", "pivot", "annulus").agg(
            F.count("*").alias("members"),
            F.min("distance").alias("near"),
            F.max("distance").alias("far"),
            F.max("square").alias("largest"),
        ),
        "annuli",
    ).withColumn("shelves", F.ceil(F.col("members") / shelf).cast("int"))
    return placed, directory, fitted


def _bounds(x: np.ndarray, square: np.ndarray, pivots: np.ndarray, table: dict[str, np.ndarray]) -> np.ndarray:
    """[query, annulus]: no score of the annulus is above."""
    apart = _apart(x, pivots)[:, table["pivot"]]
    least = np.maximum(0, np.maximum(apart - table["far"], table["near"] - apart))
    by_distance = (square[:, None] + table["largest"] - least**2) / 2
    by_norms = np.sqrt(square[:, None] * table["largest"])
    room = SLACK * (square[:, None] + table["largest"] + apart**2 + 1)
    return np.minimum(by_distance, by_norms) + room


def _visits(tables: dict[int, dict[str, np.ndarray]], pivots: dict[int, np.ndarray], first: int, last: int):
    """Rows of a query, one for each annulus from place ``first`` to ``last`` in its order that may matter.

    The own annulus has place 0. ``floor`` is the k-th best score so far, null without k scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy(zero_copy_only=False)
            for n in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                table = tables[n]
                step = max(1, CELLS // len(table["pivot"]))
                for start in range(0, part.num_rows, step):
                    yield visited(part.slice(start, step), table, pivots[n])

    def visited(part: pa.RecordBatch, table: dict[str, np.ndarray], own_pivots: np.ndarray) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.int32)
        x = x.reshape(part.num_rows, own_pivots.shape[1]).astype(np.float64)
        bounds = _bounds(x, (x**2).sum(axis=1), own_pivots, table)
        floor = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
        own = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "annulus")], axis=1)
        same = (table["pivot"] == own[:, :1]) & (table["annulus"] == own[:, 1:])
        order = np.argsort(np.where(same, -np.inf, -bounds), axis=1, kind="stable")[:, first:last]
        # Without k scores yet the floor is no number, and nothing is below it.
        at, place = np.nonzero(~(np.take_along_axis(bounds, order, axis=1) < floor[:, None]))
        cell = order[at, place]
        taken = part.select(["row", "query_id", "n", "x", "floor"]).take(pa.array(at))
        columns = dict(zip(taken.schema.names, taken.columns))
        for name in ("pivot", "annulus", "shelves"):
            columns[name] = pa.array(table[name][cell], pa.int32())
        return pa.RecordBatch.from_pydict(columns)

    return run


VISITS = "row BIGINT, query_id BIGINT, n INT, x BINARY, floor BIGINT, pivot INT, annulus INT, shelves INT"


def _top(scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, best: int) -> np.ndarray:
    """The places of the ``best`` highest scores, ties to the smaller number, no number last."""
    if len(scores) > best:
        least = np.partition(scores, len(scores) - best)[len(scores) - best]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], unknown[near], -scores[near]))][:best]


def _scan(best: int):
    """Of each query the best of a shelf that are not below its floor. Rows are sorted by shelf, vectors first."""

    def flush(shelf: dict, asked: list[dict]) -> Iterator[pa.RecordBatch]:
        if not asked or not len(shelf["rows"]):
            return
        x, n = shelf["x"], shelf["x"].shape[1]
        q = np.array([np.frombuffer(r["x"], np.int32) for r in asked]).reshape(len(asked), n).astype(np.int64)
        peak = int(np.abs(q).max(initial=0)) * shelf["peak"] * max(1, n)
        if peak < 1 << 53:
            scores = (q.astype(np.float64) @ shelf["real"].T).astype(np.int64)
        else:
            scores = q @ x.T
        out: list[tuple] = []
        for i, asker in enumerate(asked):
            able = shelf["rows"] != asker["row"]
            if asker["floor"] is not None:
                able &= scores[i] >= asker["floor"]
            able = np.flatnonzero(able)
            for place in able[_top(scores[i][able], shelf["ids"][able], shelf["unknown"][able], best)]:
                vec_id = None if shelf["unknown"][place] else int(shelf["ids"][place])
                out.append((asker["row"], int(shelf["rows"][place]), vec_id, int(scores[i][place])))
        if out:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "row", "vec_id", "score"])

    def gathered(vectors: list[dict], n: int) -> dict:
        x = np.array([np.frombuffer(r["x"], np.int32) for r in vectors]).reshape(len(vectors), n).astype(np.int64)
        return {
            "x": x,
            "real": x.astype(np.float64),
            "peak": int(np.abs(x).max(initial=0)),
            "rows": np.array([r["row"] for r in vectors], np.int64),
            "ids": np.array([r["vec_id"] or 0 for r in vectors], np.int64),
            "unknown": np.array([r["vec_id"] is None for r in vectors], bool),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, vectors, shelf, asked = None, [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["task"] != task:
                    if asked:
                        yield from flush(shelf, asked)
                    task, vectors, shelf, asked = row["task"], [], None, []
                if row["asks"]:
                    if shelf is None:
                        shelf, vectors = gathered(vectors, row["n"]), []
                    asked.append(row)
                    if len(asked) == TOGETHER:
                        yield from flush(shelf, asked)
                        asked = []
                else:
                    vectors.append(row)
        if asked:
            yield from flush(shelf, asked)

    return run


def _scores(placed: DataFrame, visits: DataFrame, shelf: int, parts: int, best: int) -> DataFrame:
    """What the visits find: (query, row, vec_id, score)."""
    dealt = lambda among: F.pmod(F.xxhash64("row"), among).cast("int")
    every = lambda among: F.explode(F.sequence(F.lit(0), among - 1))
    visits = visits.withColumn("shelf", every(F.col("shelves"))).withColumn("part", dealt(F.lit(parts)))
    cells = visits.select("n", "pivot", "annulus").distinct()
    place = ("n", "pivot", "annulus", "shelf", "part")
    columns = ("row", "vec_id", "n", "x", "floor")
    task = F.xxhash64(*place).alias("task")
    vectors = (
        placed.withColumn("shelf", dealt(F.col("shelves")))
        .withColumn("part", every(F.lit(parts)))
        .withColumn("floor", F.lit(None).cast("bigint"))
        .join(F.broadcast(cells), ["n", "pivot", "annulus"], "left_semi")
    )
    asking = visits.withColumnRenamed("query_id", "vec_id")
    both = vectors.select(*columns, task, F.lit(False).alias("asks")).unionByName(
        asking.select(*columns, task, F.lit(True).alias("asks"))
    )
    return both.repartition("task").sortWithinPartitions("task", "asks").mapInArrow(_scan(best), FOUND)


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def top_scores(
    vectors: DataFrame,
    best: int = BEST,
    every: int = EVERY,
    scale: int = SCALE,
    sample: int = SAMPLE,
    pivots: int = PIVOTS,
    annulus: int = ANNULUS,
    annuli: int = ANNULI,
    shelf: int = SHELF,
    seed: int = SEED,
    steps: list | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector whose number ``every`` divides its best others.

    Vectors that are null or hold null or non-finite components take no part; vectors are compared with
    those of their own length alone, empty ones at score 0. Repeated rows are separate queries and
    candidates that share a number. A vector without a number is a candidate, after all others of its
    score, but no query. Fewer candidates give fewer rows. Components beyond what lets an inner product
    fit a long count as the bound. ``steps``, if given, gets the number of visits of each step. Other
    columns are ignored.
    """
    whole = stored(whole_vectors(vectors, scale), "whole")
    if whole.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")
    placed, directory, fitted = _index(whole, sample, pivots, annulus, annuli, shelf, seed)
    lengths = sorted(fitted)
    listed = directory.where(F.col("n").isin(lengths)).orderBy("n", "pivot", "annulus").toPandas()
    tables = {
        n: {name: own[name].to_numpy() for name in ("pivot", "annulus", "near", "far", "largest", "shelves")}
        for n, own in listed.groupby("n")
    }
    others = ~F.col("n").isin(lengths)
    shelves = directory.select("n", "pivot", "annulus", "shelves")
    placed = stored(placed.join(F.broadcast(shelves), ["n", "pivot", "annulus"]), "placed")
    asking = placed.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    n_asking = asking.count()
    parts = max(1, math.ceil(n_asking / ASKERS))
    known = asking.where(~others)
    found = None
    for first, last in ((0, 1), (1, 1 + NEXT), (1 + NEXT, None)):
        if found is None:
            floors = known.withColumn("floor", F.lit(None).cast("bigint"))
        else:
            least = _ranked(found, best).groupBy("query").agg(F.min("score").alias("floor"), F.count("*").alias("had"))
            least = least.where(F.col("had") >= best).select(F.col("query").alias("row"), "floor")
            floors = known.join(least, "row", "left")
        visits = stored(floors.mapInArrow(_visits(tables, fitted, first, last), VISITS), "visits")
        if steps is not None:
            steps.append(visits.count())
        scores = stored(_scores(placed, visits, shelf, parts, best), "scores")
        found = scores if found is None else found.unionByName(scores)
    # Lengths the sample missed have one annulus each and no pivots.
    rare = asking.where(others).select("row", "query_id", "n", "x", F.lit(None).cast("bigint").alias("floor"), "pivot", "annulus", "shelves")
    found = found.unionByName(_scores(placed.where(others), rare, shelf, parts, best))
    ranked = _ranked(found, best).withColumnRenamed("row", "other")
    numbers = asking.select(F.col("row").alias("query"), "query_id")
    return ranked.join(numbers, "query").select("query_id", "rank", "vec_id", "score")


def op13_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(read(spark, sf_dir, "embeddings"))


SQL = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, [floor({SCALE} * e::DOUBLE) for e in embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v q JOIN v ON q.r <> v.r AND len(q.x) = len(v.x) WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= {BEST}
"""
