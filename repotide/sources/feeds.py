"""Folders of arriving line files as streams the applications take.

Each feed is a pair of streams. Its ``rows`` have the columns ``id``, ``seq``, ``language``,
``pushed_at``, ``stargazers_count`` and ``description``; its ``rejects`` the lines that are no rows,
with the reason. ``seq`` is a text that orders rows by the time their file arrived, then by push
time, then by a hash of the row itself, so the earliest copy is the same one whenever a batch is run
again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.text import missing_to_null
from repotide.schemas import REPO_JSON
from repotide.sources import decode
from repotide.sources.decode import Decoded
from repotide.sources.files import stream_lines


def _arriving(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    lines = stream_lines(spark, path, files_per_batch)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrived"))


def _feed(decoded: Decoded, id_: str, description: Column) -> Decoded:
    columns = {
        "id": F.col(id_).cast("string"),
        "language": F.col("language"),
        "pushed_at": F.col("pushed_at"),
        "stargazers_count": F.col("stargazers_count"),
        "description": description,
    }
    instant = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    seq = F.concat_ws(
        "|",
        F.date_format("arrived", instant),
        F.coalesce(F.date_format("pushed_at", instant), F.lit("")),
        F.hex(F.xxhash64(*columns.values())),
    )
    rows = decoded.rows.select(*(value.alias(name) for name, value in columns.items()), seq.alias("seq"))
    return Decoded(rows, decoded.rejects)


def json_feed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> Decoded:
    """Repositories as JSON lines with the description already cut into words."""
    lines = _arriving(spark, path, files_per_batch)
    found = decode.decode_json(lines, REPO_JSON, ["arrived"], key="full_name", time="pushed_at")
    found = found._replace(rows=decode.repo_rows(found.rows))
    return _feed(found, "full_name", F.array_join("description", " "))


def envelope_feed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> Decoded:
    """Search responses, one per line, with many repositories each."""
    found = decode.unnest_envelopes(_arriving(spark, path, files_per_batch), keep=["arrived"])
    found = found._replace(rows=decode.repo_rows(found.rows))
    return _feed(found, "id", F.col("description"))


def tsv_feed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> Decoded:
    """Repositories as five tab-separated fields with the raw description.

    The text ``None`` as a language stays a text, as the bucket program counts it.
    """
    found = decode.decode_tsv(_arriving(spark, path, files_per_batch), keep=["arrived"])
    return _feed(found, "full_name", missing_to_null(F.col("description")))


def number_feed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> Decoded:
    """One whole number per line, as ``value`` with its arrival ``ts``."""
    found = decode.decode_integers(_arriving(spark, path, files_per_batch), keep=["arrived"])
    rows = found.rows.select("value", F.col("arrived").cast("timestamp").alias("ts"))
    return found._replace(rows=rows)
