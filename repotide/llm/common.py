"""What several operators share: tables, words, stored steps, checked broadcasts, grouped batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.session import input_bytes, run_dir

# Anything but letters, marks and digits separates words.
SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"
SHINGLE_WORDS = 5
# Bytes of files as written whose rows may be broadcast; beyond, joins shuffle. In memory they are several times that.
BROADCAST_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written below the shared folder and read again: cuts the lineage for good."""
    path = run_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def hinted(rows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Stored rows with a broadcast hint if the files they are read from are small, else as they are."""
    folders = {path.rpartition("/")[0] for path in rows.inputFiles()}
    size = sum(input_bytes(rows.sparkSession, folder) for folder in folders)
    return F.broadcast(rows) if size <= limit else rows


def text_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"])


def picked(docs: DataFrame, chosen: DataFrame, total: Callable[[str], Column] = F.sum) -> DataFrame:
    """The rows of ``docs`` as often as ``chosen`` (doc_id, text_id, copies) says.

    ``chosen`` has a row for each row of ``docs``; those left out are not picked. Rows equal in number
    and text are one document, whose copies are the ``total`` of theirs.
    """
    chosen = chosen.groupBy("doc_id", "text_id").agg(F.count("*").alias("__rows"), total("copies").alias("__copies"))
    chosen = chosen.where(F.col("__copies") > 0).withColumnsRenamed({"doc_id": "__id", "text_id": "__text"})
    chosen = stored(chosen, "picked")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (text_key(docs) == F.col("__text"))
    rows = docs.join(hinted(chosen), same)
    if not chosen.where(F.col("__rows") > 1).isEmpty():
        again = rows.where(F.col("__rows") > 1).dropDuplicates(["__id", "__text"])
        rows = rows.where(F.col("__rows") == 1).unionByName(again)
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return rows.drop("__id", "__text", "__rows", "__copies", "__copy")


def words(text: Column) -> Column:
    """Lower-case words; none for null."""
    found = F.array_remove(F.split(F.lower(text), SEPARATORS), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def held_out(doc_id: Column) -> Column:
    """Every fifth document by its number; null numbers are never held out."""
    fifth = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(fifth == 0, F.lit(False))


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without null lists."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the output."""
    values = (values ^ (values >> np.uint64(30))) * MIX2
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(values: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS):
    """Hashes of the runs of k words of each row, in order, and their offsets.

    A row of one to k-1 words has one shingle, all of it; a row without words has none.
    """
    values = values.astype(np.int64).view(np.uint64)
    n = np.diff(offsets)
    many = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(many)])
    if not ends[-1]:
        return np.zeros(0, np.uint64), ends
    start = np.repeat(offsets[:-1] - ends[:-1], many) + np.arange(ends[-1])
    left = np.repeat(offsets[1:], many) - start
    out = np.zeros(len(start), np.uint64)
    for j in range(k):
        word = np.where(j < left, values[np.minimum(start + j, len(values) - 1)], np.uint64(0))
        out = (out ^ word) * MIX
        out ^= out >> np.uint64(32)
    return mixed(out), ends


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Runs of rows with one key, from batches sorted by it. A run must fit in memory."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != current:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows


def in_blocks(members: DataFrame, key: list[str], salt: str, block: int) -> DataFrame:
    """Members of groups, dealt into tasks that compare every pair of a group once.

    A group with more than ``block`` members falls into blocks by the hash of ``salt``; each pair of
    blocks is one task, named by ``task``, so a hot group is spread over many. ``side`` is the
    member's block. Members of one group must differ in ``salt``. ``n_members`` holds group sizes.
    """
    blocks = F.ceil(F.col("n_members") / F.lit(block)).cast("int")
    return (
        members.withColumn("n_blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64(salt), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
        .withColumn("task", F.xxhash64(*key, "low", "high"))
        .drop("n_blocks", "other")
    )


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
