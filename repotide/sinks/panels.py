"""Several result tables written as one commit.

A writer for batches and streams: each task writes the rows of each panel it holds to files of its own
and sends back their names in its commit message. The commit, on the driver, puts the names from all
tasks into one manifest, which appears by a rename. Readers follow the newest manifest, so they see all
panels of a commit or none, whatever fails in between; files no manifest names are never read, and an
aborted commit removes its own. A commit that is repeated replaces its manifest by one that says the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

NAME = "panel_files"
PANEL = "panel"
MANIFESTS, DATA = "manifests", "data"
# Commits whose files stay besides the newest.
KEPT = 10


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task, by panel."""

    files: dict[str, list[str]] = field(default_factory=dict)


class _Writer:
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = place_of(self.path)
        files.create_dir(f"{folder}/{DATA}")
        written, open_files = Written(), {}
        try:
            for batch in iterator:
                names = batch.column(PANEL)
                rows = batch.drop_columns([PANEL])
                for panel in pc.unique(names).to_pylist():
                    if panel not in open_files:
                        name = f"{uuid.uuid4().hex}.parquet"
                        written.files.setdefault(panel, []).append(name)
                        open_files[panel] = pq.ParquetWriter(f"{folder}/{DATA}/{name}", rows.schema, filesystem=files)
                    open_files[panel].write_batch(rows.filter(pc.equal(names, panel)))
        finally:
            for opened in open_files.values():
                opened.close()
        return written

    def put(self, messages: list[Written | None], number: int) -> None:
        files, folder = place_of(self.path)
        files.create_dir(f"{folder}/{MANIFESTS}")
        listed: dict[str, list[str]] = {}
        for message in messages:
            for panel, names in (message.files if message else {}).items():
                listed.setdefault(panel, []).extend(names)
        staged = f"{folder}/{MANIFESTS}/_{uuid.uuid4().hex}"
        with files.open_output_stream(staged) as out:
            out.write(json.dumps({"number": number, "files": listed}).encode())
        files.move(staged, f"{folder}/{MANIFESTS}/{number:012d}.json")
        self.forget(number - KEPT)

    def take_back(self, messages: list[Written | None]) -> None:
        files, folder = place_of(self.path)
        for message in messages:
            for names in (message.files if message else {}).values():
                for name in names:
                    files.delete_file(f"{folder}/{DATA}/{name}")

    def forget(self, before: int) -> None:
        """Remove commits before a number, with their files."""
        files, folder = place_of(self.path)
        for number in manifest_numbers(self.path):
            if number < before:
                for names in read_manifest(self.path, number).values():
                    for name in names:
                        files.delete_file(f"{folder}/{DATA}/{name}")
                files.delete_file(f"{folder}/{MANIFESTS}/{number:012d}.json")


class BatchWriter(_Writer, DataSourceArrowWriter):
    def __init__(self, path: str, number: int) -> None:
        super().__init__(path)
        self.number = number

    def commit(self, messages: list[Written | None]) -> None:
        self.put(messages, self.number)

    def abort(self, messages: list[Written | None]) -> None:
        self.take_back(messages)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.put(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.take_back(messages)


class PanelFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options["path"], int(self.options["number"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"])


def manifest_numbers(path: str) -> list[int]:
    """The commits there are, in order."""
    files, folder = place_of(path)
    found = files.get_file_info(fs.FileSelector(f"{folder}/{MANIFESTS}", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[0] != "_")


def read_manifest(path: str, number: int) -> dict[str, list[str]]:
    files, folder = place_of(path)
    with files.open_input_stream(f"{folder}/{MANIFESTS}/{number:012d}.json") as opened:
        return json.loads(opened.read())["files"]


def as_panels(panels: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all panels, which have the same columns, with the name of theirs."""
    named = [rows.select(F.lit(name).alias(PANEL), *rows.columns) for name, rows in panels.items()]
    return reduce(DataFrame.unionByName, named)


def commit_panels(rows: DataFrame, path: str, number: int | None = None) -> int:
    """Write all panels as one commit: the given one, or the one after the newest."""
    spark = rows.sparkSession
    if number is None:
        number = max(manifest_numbers(path), default=-1) + 1
    spark.dataSource.register(PanelFiles)
    writer = rows.write.format(NAME).mode("append").option("path", path).option("number", number)
    writer.save()
    return number


def read_panels(spark: SparkSession, path: str, schema: str) -> dict[str, DataFrame]:
    """The panels of the newest commit; those without rows are not there."""
    numbers = manifest_numbers(path)
    if not numbers:
        return {}
    listed = read_manifest(path, numbers[-1])
    reader = spark.read.schema(schema)
    return {panel: reader.parquet(*(f"{path}/{DATA}/{name}" for name in names)) for panel, names in listed.items()}
