"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns several points on a ring. A unit of rows hashes to a point and goes to the shard of
the next ring point clockwise. A shard holds at most ``1 + slack`` times the mean number of bytes;
it keeps the units of lowest rank and passes the others on to the next shard clockwise, which
does the same. Ranks are hashes, so the outcome does not depend on any order of arrival and reruns
agree.

Units are equal texts, which thus stay together. A group of copies above ``piece`` of a shard's
mean load is salted into pieces by document number, each with its own point, so that no group
overfills a shard.

The loads are decided on a histogram over (ring arc, rank bucket), whose size depends on the number
of shards alone. Only it reaches the driver.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import read, stored

SHARDS = 8
# Points of a shard on the ring, cells of the ring, and buckets of ranks.
VIRTUAL, RING, RANKS = 64, 1 << 14, 512
SLACK = 0.01
# Largest unit as a part of a shard's mean load.
PIECE = 0.01
# Rows that are numbered in one task.
SLOT_ROWS = 100_000


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """The arc that each cell of the ring is on, and the order of shards clockwise from each arc.

    A point's cell is a hash of (shard, copy), or the next free one, whatever other shards there
    are after it, so one more shard moves no point of another. An arc ends at its point.
    """
    if shards * virtual > RING // 2:
        raise ValueError("too many points for the ring")
    owner = np.full(RING, -1)
    for number in range(shards):
        for copy in range(virtual):
            key = f"{number}/{copy}".encode()
            cell = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little") % RING
            while owner[cell] >= 0:
                cell = (cell + 1) % RING
            owner[cell] = number
    cells = np.flatnonzero(owner >= 0)
    owners = owner[cells]
    arcs = np.searchsorted(cells, np.arange(RING)) % len(cells)
    orders = []
    for arc in range(len(owners)):
        clockwise = np.concatenate([owners[arc:], owners[:arc]])
        _, first = np.unique(clockwise, return_index=True)
        orders.append(clockwise[np.sort(first)])
    return arcs, np.array(orders)


def bounded_loads(load: np.ndarray, orders: np.ndarray, capacity: float) -> np.ndarray:
    """The shard of every (arc, rank) cell.

    Each shard accepts ranks below its limit. Limits start open and fall where a shard is over
    capacity; cells that are passed on move clockwise. Limits only fall, so this ends. Cells that
    all shards refuse, which whole units can cause in tiny inputs, go to the emptiest shard.
    """
    arcs, ranks = load.shape
    shards = orders.shape[1]
    limit = np.full(shards, ranks)
    rank = np.arange(ranks)
    while True:
        accepts = rank[None, :] < limit[:, None]
        place = np.full((arcs, ranks), -1)
        for step in range(shards):
            wanted = orders[:, step]
            place = np.where((place < 0) & accepts[wanted], wanted[:, None], place)
        moved = False
        for shard in range(shards):
            held = np.where(place == shard, load, 0).sum(axis=0)
            if held.sum() > capacity:
                limit[shard] = np.searchsorted(np.cumsum(held), capacity, side="right")
                moved = True
        if not moved:
            break
    totals = np.bincount(place[place >= 0], load[place >= 0], minlength=shards)
    for arc, r in np.argwhere((place < 0) & (load > 0)):
        place[arc, r] = int(np.argmin(totals))
        totals[place[arc, r]] += load[arc, r]
    return place


def shard(rows: DataFrame, shards: int = SHARDS, slack: float = SLACK, piece: float = PIECE):
    """Rows (doc_id, size, text_crc32, key) with ``shard`` and ``slot``.

    ``key`` names the group to keep together; a null key or number is a key or number like any
    other. Repeated rows are separate rows. No rows give no rows.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    mean = max(1.0, total / shards)
    # At most shards / piece groups are that large.
    large = rows.groupBy("key").agg(F.sum("size").alias("group_size"))
    large = large.where(F.col("group_size") > F.lit(piece * mean))
    large = stored(large.withColumnRenamed("key", "large_key"), "large")
    pieces = F.ceil(F.col("group_size") / F.lit(piece * mean))
    split = F.when(
        F.col("group_size").isNotNull(), F.pmod(F.xxhash64(F.lit("piece"), "doc_id"), pieces)
    ).otherwise(F.lit(0).cast("bigint"))
    arcs, orders = ring(shards)
    # One literal, folded to an array of RING numbers once.
    cells_arcs = F.from_json(F.lit(json.dumps(arcs.tolist())), "array<int>")
    placed = (
        rows.join(F.broadcast(large), F.col("key") == F.col("large_key"), "left")
        .withColumn("point", F.xxhash64(F.lit("point"), "key", split))
        .withColumn("rank", F.pmod(F.xxhash64(F.lit("rank"), "point"), F.lit(RANKS)).cast("int"))
        .withColumn("arc", F.element_at(cells_arcs, F.pmod("point", F.lit(RING)).cast("int") + 1))
        .drop("large_key", "group_size")
    )
    placed = stored(placed, "placed")
    cells = placed.groupBy("arc", "rank").agg(F.sum("size").alias("size")).toPandas()
    load = np.zeros((shards * VIRTUAL, RANKS))
    load[cells["arc"], cells["rank"]] = cells["size"]
    place = bounded_loads(load, orders, (1 + slack) * mean)
    cells["shard"] = place[cells["arc"], cells["rank"]].astype("int32")
    # One row for each occupied cell: at most shards * VIRTUAL * RANKS rows of three integers.
    table = spark.createDataFrame(cells[["arc", "rank", "shard"]], "arc INT, rank INT, shard INT")
    return slots(placed.join(F.broadcast(table), ["arc", "rank"]).drop("arc", "rank", "point"))


def slots(rows: DataFrame, per_task: int = SLOT_ROWS) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, with many tasks to a shard."""
    parts = max(1, -(-rows.count() // per_task))
    part = F.pmod(F.xxhash64(F.lit("slot"), "doc_id", "text_crc32"), F.lit(parts))
    rows = rows.withColumn("part", part.cast("int"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("within", F.row_number().over(within))
    slot = (F.col("before") + F.col("within") - 1).cast("bigint")
    # As many rows as numbering tasks.
    joined = numbered.join(before, ["shard", "part"])
    return joined.withColumn("slot", slot).drop("before", "within", "part")


def documents_to_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document with its shard, under the law ``bytes``.

    A null text has size 1, as an empty one. Equal texts share a shard unless their group was split
    or a shard's limit falls between its pieces. A text larger than a shard's limit goes to one shard all
    the same. Other columns of the input are ignored.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    )
    return shard(rows, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_to_shards(read(spark, sf_dir, "documents"))
