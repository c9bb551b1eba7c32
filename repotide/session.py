"""Session set-up and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_own_folders: dict[str, str] = {}
# Folders named by ``run_dir`` and not removed since.
_made: list[str] = []

# Options any session may change while it runs.
OPTIONS = {
    # Every instant is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Lets adaptive execution swap a sort-merge join for a hash join once it has seen that every
    # build partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # What a Python worker is sent at once, but for a single row that is larger.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}

PARTITIONS = "spark.sql.shuffle.partitions"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Input bytes for each partition a batch shuffle starts from; adaptive execution merges small ones.
PARTITION_BYTES = 256 << 20


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder or file, from the listing alone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength()


def prepare(spark: SparkSession, path: str | None = None) -> SparkSession:
    """A session with the options the queries rely on; those of ``spark`` stay as they are.

    Streaming queries freeze ``spark.sql.shuffle.partitions`` in their checkpoint, on a cluster as
    in one process. Batch shuffles start from that number too, or from one partition for every
    PARTITION_BYTES of the input at ``path``, whichever is more.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in OPTIONS.items():
        own.conf.set(name, value)
    if path:
        first = max(int(own.conf.get(PARTITIONS)), -(-input_bytes(spark, path) // PARTITION_BYTES))
        own.conf.set(FIRST_PARTITIONS, str(first))
    return own


def get_session(app: str = "repotide", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution, UTC and the UI switched off.

    ``master`` stays unset on a cluster, where the submit command names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **OPTIONS,
        **{name.replace("__", "."): str(value) for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting only a session in one process, such as a test, gets a folder of its own;
    on a cluster no machine-local folder would do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="run-")
    return _own_folders[application]


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name for one run below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def folders_made() -> Iterator[list[str]]:
    """Fills a list with the folders that a block has named and not removed."""
    before, made = set(_made), []
    try:
        yield made
    finally:
        made += [path for path in _made if path not in before]


def sweep(spark: SparkSession) -> None:
    """Remove all folders written by this process, when no result that reads them is needed any more."""
    for path in list(_made):
        remove_folder(spark, path)


def make_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of written rows that nothing reads any more; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if path in _made:
        _made.remove(path)


@contextmanager
def settings(spark: SparkSession, **conf: object) -> Iterator[None]:
    """Set session options for a block, then put the old ones back.

    A streaming query copies the options when it starts, so wrapping its start is enough.
    """
    names = {name.replace("__", "."): str(value) for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
