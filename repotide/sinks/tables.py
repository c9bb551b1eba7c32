"""Written tables: per-batch result tables, CSV, and the tables a dashboard reads.

A result table has one ``batch_id=<n>`` folder per micro-batch. A batch that runs again after a
failure overwrites its own folder, so a repeated batch changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.session import remove_folder

COUNTS, RECENTS, STARS, TOP = "dash_counts", "dash_recents", "dash_stars", "dash_top10"

DASHBOARD = {
    COUNTS: "lang STRING, count BIGINT",
    RECENTS: "batch_time TIMESTAMP, Language STRING, Recents BIGINT",
    STARS: "Language STRING, Average_Stars DOUBLE",
    TOP: "Language STRING, Word STRING, Freq BIGINT",
}


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def publish_once(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch for streaming readers: it appears by one rename, and stays as it is if it is there.

    A batch that runs again thus adds no file that a reader would take for a new one.
    """
    spark = rows.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(batch_folder(path, batch_id))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return
    # Readers pass over names that start so.
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), target):
        raise OSError(f"batch {batch_id} could not be published below {path}")


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(batch_folder(path, batch_id))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a result table, with the batch as a partition column."""
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """The batches of a result table in order, from its folder names alone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def latest_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest snapshot in a result table; no file of an older one is opened."""
    found = batch_numbers(spark, path)
    if not found:
        return spark.createDataFrame([], schema)
    return read_batch(spark, path, found[-1], schema)


def forget_batches(spark: SparkSession, path: str, before: int) -> None:
    """Remove the folders of batches ``before`` a number, for tables of snapshots."""
    for number in batch_numbers(spark, path):
        if number < before:
            remove_folder(spark, batch_folder(path, number))


def write_csv(table: DataFrame, path: str) -> None:
    """One header line per part file and no row numbers."""
    table.write.option("header", True).csv(path)


def register(table: DataFrame, name: str | None = None, everywhere: bool = False) -> str:
    """Register a view and return the name to use in SQL; a view without a name gets one of its own.

    A view registered everywhere lives in ``global_temp`` and is seen by all sessions.
    """
    name = name or f"view_{uuid.uuid4().hex}"
    if everywhere:
        table.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    table.createOrReplaceTempView(name)
    return name


@contextmanager
def view(table: DataFrame, name: str | None = None, everywhere: bool = False) -> Iterator[str]:
    """A view for the length of a block. What a query made of it stays valid afterwards."""
    full = register(table, name, everywhere)
    catalog = table.sparkSession.catalog
    try:
        yield full
    finally:
        drop = catalog.dropGlobalTempView if everywhere else catalog.dropTempView
        drop(full.split(".")[-1])


def describe(table: DataFrame) -> DataFrame:
    """Name, type and nullability of each column."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in table.schema.fields]
    spark = table.sparkSession
    return spark.createDataFrame(rows, "name STRING, type STRING, nullable BOOLEAN")


def as_columns(table: DataFrame, *order: str) -> DataFrame:
    """One row holding each column as an array, all in the same order.

    For results that are short by their making, such as a row per tracked language.
    """
    entry = F.struct(*order, *(name for name in table.columns if name not in order))
    gathered = table.agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    return gathered.select(*(F.col(f"rows.{name}").alias(name) for name in table.columns))


def to_dict(columns: DataFrame) -> dict[str, list]:
    """The output of ``as_columns`` on the driver."""
    row = columns.first()
    return {name: row[name] for name in columns.columns}
