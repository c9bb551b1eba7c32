"""Connected components of a large edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from repotide.llm.common import stored

# So many edges or fewer are joined in one task.
FEW = 1 << 14


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a").where(F.col("b") > F.col("a"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of edges that all come to one task."""
    up: dict = {}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            up.setdefault(a, a)
            up.setdefault(b, b)
            one, other = root(a), root(b)
            if one != other:
                up[max(one, other)] = min(one, other)
    if up:
        nodes = list(up)
        yield pa.RecordBatch.from_pydict(
            {"node": pa.array(nodes, kind), "component": pa.array([root(x) for x in nodes], kind)}
        )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of the edges (a, b) with the smallest node it is linked to.

    Nodes may be of any ordered type. Loops and repeated edges do no harm, edges with a null are
    ignored; no edges give no rows. Every half round is one grouping and one join, whose hubs
    adaptive execution splits; its result is written below the shared folder, so a lost executor
    costs one half round. ``FEW`` edges or fewer are joined at once, in one task, to the same result.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    if edges.count() <= FEW:
        kind = edges.schema["a"].dataType
        out = StructType([StructField("node", kind), StructField("component", kind)])
        return stored(edges.coalesce(1).mapInArrow(_joined, out), "joined")
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)).where("a <> b").distinct(), "stars")
        row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.union(roots)
