"""Poll rounds as a streaming source with offsets.

A round is one poll of a service: a folder ``batch_id=<n>`` of Parquet files that appears at once
(``sinks.tables.publish_once``). The offset of the stream is the number of the next round. A batch takes
all rounds that are there, whole, one task per file; what was taken is in the checkpoint, so over stops
and restarts each round comes exactly once. Rounds below the offset that appear later are not read.

Files are opened by pyarrow in the tasks, on any file system it knows by the address of the folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "poll_rounds"


class RoundFile(InputPartition):
    def __init__(self, number: int, path: str) -> None:
        self.number, self.path = number, path


class PollReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema

    def _place(self) -> tuple[fs.FileSystem, str]:
        if ":/" in self.path:
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def _rounds(self) -> dict[int, str]:
        files, folder = self._place()
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        rounds = (f for f in found if f.type == fs.FileType.Directory)
        return {int(f.base_name.split("=")[1]): f.path for f in rounds if f.base_name.startswith("batch_id=")}

    def initialOffset(self) -> dict:
        return {"round": 0}

    def latestOffset(self) -> dict:
        return {"round": max(self._rounds(), default=-1) + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files, _ = self._place()
        parts: list[InputPartition] = []
        for number, folder in sorted(self._rounds().items()):
            if start["round"] <= number < end["round"]:
                listed = files.get_file_info(fs.FileSelector(folder))
                parts += [RoundFile(number, f.path) for f in listed if f.base_name.endswith(".parquet")]
        return parts

    def read(self, partition: RoundFile) -> Iterator[pa.RecordBatch]:
        files, _ = self._place()
        wanted = to_arrow_schema(self.schema)
        names = [name for name in wanted.names if name != "round"]
        with files.open_input_file(partition.path) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(columns=names):
                number = pa.array([partition.number] * batch.num_rows, pa.int64())
                columns = {**{name: batch.column(name) for name in names}, "round": number}
                yield pa.RecordBatch.from_pydict({name: columns[name] for name in wanted.names}).cast(wanted)


class PollRounds(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return self.options["columns"]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PollReader(self.options["path"], schema)


def _register(spark: SparkSession, tries: int = 3) -> None:
    """Make the source known to a session, which may know it already.

    Spark calls a new name taken, too, whenever it fails to look the name up, for whatever reason; a
    failure that passes is tried again.
    """
    for left in reversed(range(tries)):
        try:
            return spark.dataSource.register(PollRounds)
        except AnalysisException as error:
            if not left or error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
                raise


@contextmanager
def _active(spark: SparkSession) -> Iterator[None]:
    """Make a session the active one of this thread for a block.

    Spark looks a new name up in the active session, and one that knows the source makes it taken for all.
    """
    sessions = SparkSession._get_j_spark_session_class(spark._jvm)
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        yield
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()


def stream_polls(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The rounds below a folder as a stream of ``columns``, with the number of their ``round``."""
    with _active(spark):
        _register(spark)
    reader = spark.readStream.format(NAME).option("columns", f"{columns}, round BIGINT")
    return reader.option("path", path).load()
