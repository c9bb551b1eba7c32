"""Exact first-seen-wins intake of a stream, at a cost that does not grow with what was seen.

Two queries, neither of which runs Python or holds a text:

* **arrivals** writes every row exactly once, as it came, to the table ``arrivals``, stamped with the
  logged clock of its batch, ``taken``.
* **seen** reads that table as a stream, without its wide columns. State holds for each key where its earliest
  row is; keys are combined within tasks, so a hot key costs a row per task. Every key of a batch has a
  row in the table ``keys``, which says whether it is new and where its first row is.

A row is accepted if it is the first of a key, and all others have a reason why not. Rows are found by where they
lie in ``arrivals``, which is unique, so copies of a key spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repotide.operators.dedup import DUPLICATE, missing_reason
from repotide.session import make_folder
from repotide.sinks.tables import batch_numbers, read_batch, read_batches, write_batch
from repotide.streaming.queries import finish, start, start_table
from repotide.streaming.state import first_seen_updates

# A row that ``seen`` has not read yet is neither accepted nor rejected.
PENDING = "pending"
TAKEN, PLACE = "taken", "place"
KEYS = f"is_new BOOLEAN, last BIGINT, {TAKEN} BIGINT, {PLACE} BIGINT"

NewRows = Callable[[DataFrame, int], None]


def _place() -> Column:
    """Where a row lies in the table."""
    return F.xxhash64("_metadata.file_name", "_metadata.row_index").alias(PLACE)


def arrivals(spark: SparkSession, out: str, schema: str, streaming: bool = False) -> DataFrame:
    """Every row taken in, with ``taken`` and ``place``; ``schema`` names the columns wanted."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(f"{schema}, {TAKEN} BIGINT").parquet(f"{out}/arrivals")
    return rows.select("*", _place())


def _note_keys(out: str, payload: Sequence[str], on_new: NewRows | None):
    def note(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{out}/keys"
        write_batch(batch.select("is_new", "last", "row.*"), path, batch_id)
        if on_new:
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.schema["row"].dataType)
            new = read_batch(spark, path, batch_id, f"is_new BOOLEAN, {kinds}").where("is_new")
            on_new(new.select(*payload, TAKEN, PLACE), batch_id)

    return note


def start_intake(
    stream: DataFrame,
    key: str,
    arrival: str,
    out: str,
    checkpoint: str,
    every_seconds: int | None = None,
    retention: str | None = None,
    payload: Sequence[str] = (),
    on_new: NewRows | None = None,
) -> list[StreamingQuery]:
    """Take in the rows of a stream below ``out``; without an interval, all that is there.

    ``arrival`` orders rows by arrival within a batch of the stream; of rows with one key and
    arrival any may win. A row without a key or a ``language`` is never accepted. ``on_new`` gets the
    new keys of each batch of ``seen`` as rows of ``payload`` (narrow columns), ``taken`` and ``place``.
    It may be called again with the same batch. ``retention`` (such as ``7d``) lets readers forget older
    files of ``arrivals``.
    """
    spark = stream.sparkSession
    make_folder(spark, f"{out}/arrivals")
    stamped = stream.withColumn(TAKEN, F.unix_millis(F.current_timestamp()))
    taken = start_table(
        stamped, f"{out}/arrivals", f"{checkpoint}/arrivals", [TAKEN], every_seconds, retention
    )
    if every_seconds is None:
        finish(taken)
    wanted = list(dict.fromkeys([key, arrival, "language", *payload]))
    schema = ", ".join(f"{name} {stream.schema[name].dataType.simpleString()}" for name in wanted)
    updates = first_seen_updates(
        arrivals(spark, out, schema, streaming=True),
        key,
        [TAKEN, arrival, PLACE],
        [*payload, TAKEN, PLACE],
        F.max(TAKEN).alias("last"),
    )
    note = _note_keys(out, payload, on_new)
    seen = start(updates, note, f"{checkpoint}/seen", "update", every_seconds)
    return [taken, seen]


def intake_table(spark: SparkSession, out: str, schema: str, key: str) -> DataFrame:
    """The rows taken in, with ``accepted`` and, where they are not, ``reason``.

    ``schema`` names the columns wanted, among them ``key`` and ``language``.
    """
    rows = arrivals(spark, out, schema)
    if not batch_numbers(spark, f"{out}/keys"):
        reason = F.coalesce(missing_reason(key), F.lit(PENDING))
        return rows.select("*", F.lit(False).alias("accepted"), reason.alias("reason")).drop(TAKEN, PLACE)
    keys = read_batches(spark, f"{out}/keys", KEYS)
    winners = keys.where("is_new").select(F.col(TAKEN).alias("_taken"), F.col(PLACE).alias("_place"))
    until = keys.agg(F.max("last")).scalar()
    won = (F.col(TAKEN) == F.col("_taken")) & (F.col(PLACE) == F.col("_place"))
    marked = rows.join(winners, won, "left")
    accepted = F.col("_place").isNotNull()
    later = F.when(F.col(TAKEN) > F.coalesce(until, F.lit(0)), PENDING).otherwise(DUPLICATE)
    reason = F.when(~accepted, F.coalesce(missing_reason(key), later))
    return marked.select("*", accepted.alias("accepted"), reason.alias("reason")).drop(
        TAKEN, PLACE, "_taken", "_place"
    )


def accepted_rows(table: DataFrame) -> DataFrame:
    return table.where("accepted").drop("accepted", "reason")


def rows_at(spark: SparkSession, out: str, schema: str, places: DataFrame) -> DataFrame:
    """The rows of ``arrivals`` at the given (taken, place); only the batches they lie in are read."""
    # As many numbers as batches of the stream that came in since.
    batches = [row[TAKEN] for row in places.select(TAKEN).distinct().collect()]
    rows = arrivals(spark, out, schema).where(F.col(TAKEN).isin(batches))
    return rows.join(places.select(TAKEN, PLACE), [TAKEN, PLACE], "left_semi")
