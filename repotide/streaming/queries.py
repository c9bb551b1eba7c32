"""Starting streaming queries and writing their batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from repotide.session import ROCKSDB, settings
from repotide.sinks.tables import forget_batches, write_batch

BatchFunction = Callable[[DataFrame, int], None]


def adaptive(on_batch: BatchFunction) -> BatchFunction:
    """Run ``on_batch`` with adaptive execution, which a streaming session switches off.

    A micro-batch carries no size estimate, so only adaptive execution can choose joins well.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, spark__sql__adaptive__enabled="true"):
            on_batch(batch, batch_id)

    return run


def _configured(spark: SparkSession, watermark: str = "min"):
    """State lives in RocksDB, outside the heap, with changes logged to the checkpoint."""
    return settings(
        spark,
        spark__sql__streaming__multipleWatermarkPolicy=watermark,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
    )


def _trigger(every_seconds: int | None) -> dict[str, object]:
    return {"processingTime": f"{every_seconds} seconds"} if every_seconds else {"availableNow": True}


def start(
    stream: DataFrame,
    on_batch: BatchFunction,
    checkpoint: str,
    mode: str = "update",
    every_seconds: int | None = None,
    watermark: str = "min",
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``on_batch``.

    ``every_seconds`` sets the batch interval; without it the query works through what is there
    and ends. The first start freezes the session's shuffle partitions in the checkpoint as the
    number of state partitions; they must suit the whole cluster. ``watermark`` says which of several
    feeds sets the watermark: the one farthest behind (``min``) or ahead (``max``); it is frozen too.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    with _configured(stream.sparkSession, watermark):
        return writer.foreachBatch(adaptive(on_batch)).trigger(**_trigger(every_seconds)).start()


def start_table(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    partitions: list[str],
    every_seconds: int | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Start a query that writes a Parquet table, every row exactly once, which streams can read."""
    writer = stream.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("checkpointLocation", checkpoint).option("path", out)
    if retention:
        writer = writer.option("retention", retention)
    with _configured(stream.sparkSession):
        return writer.trigger(**_trigger(every_seconds)).start()


def to_table(
    path: str, change: Callable[[DataFrame], DataFrame] | None = None, keep: int | None = None
) -> BatchFunction:
    """A batch function that writes each batch, after ``change``, to a result table.

    With ``keep`` the table holds the last so many batches and the newest, else all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(change(batch) if change else batch, path, batch_id)
        if keep is not None:
            forget_batches(batch.sparkSession, path, batch_id - keep)

    return write


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(key, value, partition_id): what a stateful operator of a stopped query holds.

    As of the last batch it finished; a batch that failed has left nothing in it.
    """
    with _configured(spark):
        return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def finish(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself; its failure is raised here."""
    query.awaitTermination()
