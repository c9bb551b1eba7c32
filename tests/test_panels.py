"""Panels written as one commit."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from repotide.sinks import panels, tables
from repotide.streaming.app import shown_panels
from repotide.streaming.queries import finish
from test_streams import analyse, arrive, expected_dashboard, made_rows, stamped, stream

SCHEMA = "language STRING, value STRING"


def panel_rows(spark, n, names=("a", "b", "c", "d")):
    return panels.as_panels({name: spark.createDataFrame([(f"l{i}", f"{name}{n}") for i in range(3)], SCHEMA) for name in names})


def read(spark, folder):
    return {name: {r.value for r in rows.collect()} for name, rows in panels.read_panels(spark, folder, SCHEMA).items()}


def commit_of(n):
    return {name: {f"{name}{n}"} for name in "abcd"}


def failing_after(name):
    """Fails in the task that writes the panel after that one, when others have been written."""

    @F.udf("string")
    def check(panel, value):
        if panel > name:
            raise RuntimeError("lost")
        return value

    return check(F.col("panel"), F.col("value"))


def test_readers_never_see_a_mixed_batch(spark, folder):
    assert panels.read_panels(spark, folder, SCHEMA) == {}
    assert panels.commit_panels(panel_rows(spark, 0), folder) == 0
    for name in "ab":
        with pytest.raises(Exception, match="lost"):
            panels.commit_panels(panel_rows(spark, 1).withColumn("value", failing_after(name)), folder)
        assert read(spark, folder) == commit_of(0)
    assert panels.commit_panels(panel_rows(spark, 1), folder) == 1
    assert read(spark, folder) == commit_of(1)
    assert all(rows.count() == 3 for rows in panels.read_panels(spark, folder, SCHEMA).values())


def test_a_commit_that_is_lost_before_its_manifest_is_not_seen(spark, folder, monkeypatch):
    panels.commit_panels(panel_rows(spark, 0), folder)
    writer = panels.BatchWriter(folder, 1)
    message = writer.write(iter(panel_rows(spark, 1).coalesce(1).toArrow().to_batches()))
    assert sorted(message.files) == list("abcd") and read(spark, folder) == commit_of(0)
    # A manifest that was being written is no manifest.
    with open(f"{folder}/manifests/_half", "w") as half:
        half.write(json.dumps({"number": 1})[:5])
    assert read(spark, folder) == commit_of(0)
    files = len(os.listdir(f"{folder}/data"))
    writer.abort([message, None])
    assert len(os.listdir(f"{folder}/data")) == files - 4
    assert read(spark, folder) == commit_of(0)


def test_a_repeated_commit_says_the_same_and_old_ones_go(spark, folder):
    for number in [*range(panels.KEPT + 3), panels.KEPT + 2]:
        panels.commit_panels(panel_rows(spark, number).coalesce(1), folder, number)
    assert read(spark, folder) == commit_of(panels.KEPT + 2)
    kept = panels.manifest_numbers(folder)
    assert kept == list(range(2, panels.KEPT + 3))
    named = {f for n in kept for own in panels.read_manifest(folder, n).values() for f in own}
    assert named <= set(os.listdir(f"{folder}/data"))


def test_a_stream_commits_each_batch(spark, folder):
    rows = [(i, f"l{i % 2}") for i in range(40)]
    arrive(spark, f"{folder}/in", rows, 4, "n BIGINT, language STRING")
    source = stream(spark, f"{folder}/in", "n BIGINT, language STRING")
    named = source.select((F.col("n") % 3).cast("string").alias("panel"), "language", F.col("n").cast("string").alias("value"))
    spark.dataSource.register(panels.PanelFiles)
    query = named.writeStream.format(panels.NAME).option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    finish(query.trigger(availableNow=True).start())
    assert panels.manifest_numbers(f"{folder}/out") == [0, 1, 2, 3]
    last = panels.read_panels(spark, f"{folder}/out", SCHEMA)
    assert sorted(int(v) for rows in last.values() for v in rows_of(rows, "value") for v in v) == list(range(30, 40))


def test_the_application_publishes_its_panels_together(spark, folder):
    rows = made_rows(120)
    arrive(spark, f"{folder}/in", rows, 2)
    finish(analyse(stamped(spark, folder), folder))
    shown = shown_panels(spark, f"{folder}/out")
    counts, stars, words = expected_dashboard(spark, rows)
    assert rows_of(shown[tables.COUNTS], "language", "value") == sorted(((l, str(n)) for l, n in counts), key=repr)
    assert rows_of(shown[tables.STARS], "language", "value") == sorted(((l, f"{n:,.4f}") for l, n in stars), key=repr)
    assert rows_of(shown[tables.TOP], "language", "value") == words
    assert shown[tables.RECENTS].count() == 6
