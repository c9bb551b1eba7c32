import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from conftest import rows_of
from repotide.operators import metrics, ranking
from repotide.sinks import console, dashboard, report, tables


def test_a_repeated_batch_overwrites_itself(spark, folder):
    for batch_id, n in ((0, 3), (1, 4), (1, 4)):
        tables.write_batch(spark.range(n), folder, batch_id)
    assert rows_of(tables.read_batches(spark, folder, "id BIGINT").groupBy("batch_id").count()) == [
        (0, 3), (1, 4),
    ]
    assert tables.latest_batch(spark, folder, "id BIGINT").count() == 4
    assert tables.read_batch(spark, folder, 0, "id BIGINT").count() == 3


def test_empty_batch_is_a_readable_snapshot(spark, folder):
    tables.write_batch(spark.range(0), folder, 0)
    assert tables.read_batch(spark, folder, 0, "id BIGINT").count() == 0


def test_csv_has_a_header(spark, folder):
    tables.write_csv(spark.createDataFrame([(1, 2)], "A INT, B INT").coalesce(1), f"{folder}/csv")
    part = [f for f in os.listdir(f"{folder}/csv") if f.endswith(".csv")][0]
    assert open(f"{folder}/csv/{part}").read() == "A,B\n1,2\n"


def test_views(spark):
    name = tables.register(spark.range(5), "numbers_here")
    everywhere = tables.register(spark.range(5), "numbers_everywhere", everywhere=True)
    assert everywhere == "global_temp.numbers_everywhere"
    assert spark.sql(f"SELECT COUNT (ID) FROM {name} WHERE id < 4").first()[0] == 4
    assert spark.newSession().sql(f"SELECT * FROM {everywhere} WHERE ID < 4").count() == 4


def test_describe(spark):
    table = spark.createDataFrame([(1, "x")], "A INT NOT NULL, b STRING")
    assert rows_of(tables.describe(table)) == [("A", "int", False), ("b", "string", True)]


def test_columns_keep_their_order(spark):
    table = spark.createDataFrame([("b", 2), ("a", None), ("c", 1)], "k STRING, v INT")
    row = tables.as_columns(table, "k").first()
    assert (row.k, row.v) == (["a", "b", "c"], [None, 2, 1])
    assert tables.to_dict(tables.as_columns(table, "k")) == {"k": ["a", "b", "c"], "v": [None, 2, 1]}


def test_run_report_format(spark, folder):
    window = spark.createDataFrame([(100, 200)], "started BIGINT, ended BIGINT")
    totals = spark.createDataFrame([("C", 4, 10), ("Perl", 1, 1)], "language STRING, count BIGINT, stars BIGINT")
    counts = spark.createDataFrame([("C", "the", 3), ("C", "a", 9)], "language STRING, word STRING, freq BIGINT")
    lists = ranking.word_lists(ranking.ranked_words(counts))
    lines = report.run_report(window, totals, lists, ["Python", "C"])
    expected = ["100:200", "Python:0:0.0", "C:4:2.5", "Python:", "C:(a,9),(the,3)"]
    assert [r.line for r in lines.orderBy("line_no").collect()] == expected
    report.write_report(lines, f"{folder}/report")
    parts = [f for f in os.listdir(f"{folder}/report") if f.startswith("part-")]
    assert len(parts) == 1
    assert open(f"{folder}/report/{parts[0]}").read().splitlines() == expected


def test_report_reproduces_published_averages(spark):
    """Counts and star sums of a published two-hour run give its printed averages."""
    totals = spark.createDataFrame(
        [("Python", 5936, 657193), ("Java", 3631, 456642), ("C", 1237, 251317)],
        "language STRING, count BIGINT, stars BIGINT",
    )
    assert {r[0]: r[1] for r in metrics.average_stars(totals).collect()} == {
        "Python": 110.7131064690027, "Java": 125.7620490223079, "C": 203.16653193209376,
    }


def test_panels_fill_gaps(spark):
    counts = spark.createDataFrame([("C", 3)], "language STRING, count BIGINT")
    assert rows_of(dashboard.totals_panel(counts, ["Python", "C"])) == [("C", 3), ("Python", 0)]
    averages = spark.createDataFrame([("C", 1.5)], "Language STRING, Average_Stars DOUBLE")
    assert rows_of(dashboard.stars_panel(averages, ["Python", "C"])) == [("C", 1.5), ("Python", 0.0)]


def test_recents_panel_is_a_full_grid(spark):
    data = [(datetime(2024, 3, 1, 10, m), "C", m) for m in range(12)]
    data.append((datetime(2024, 3, 1, 10, 11), "Perl", 5))
    recents = spark.createDataFrame(data, "batch_time TIMESTAMP, language STRING, recents BIGINT")
    panel = dashboard.recents_panel(recents, ["Python", "C"])
    assert panel.count() == 20
    assert rows_of(panel.where("label = '10:11:00'"), "Language", "Recents") == [("C", 11), ("Python", 0)]
    assert panel.agg(F.min("label")).first()[0] == "10:02:00"


def test_panels_show_other_languages_too(spark):
    counts = spark.createDataFrame([("C", 3), ("Perl", 2)], "language STRING, count BIGINT")
    totals = dashboard.totals_panel(counts, ["Python", "C"], others=True)
    assert rows_of(totals) == [("C", 3), ("Perl", 2), ("Python", 0)]
    averages = spark.createDataFrame([("Perl", 2.5), ("C", 1.5)], "Language STRING, Average_Stars DOUBLE")
    stars = dashboard.stars_panel(averages, ["Python", "C"], others=True)
    assert rows_of(stars) == [("C", 1.5), ("Perl", 2.5), ("Python", 0.0)]
    data = [(datetime(2024, 3, 1, 10, m), "C", m) for m in range(1, 12)]
    # Shell was pushed in a batch before the last ten only, Perl in that and in the last one.
    first, last = datetime(2024, 3, 1, 10, 0), datetime(2024, 3, 1, 10, 11)
    data += [(first, "Shell", 4), (first, "Perl", 7), (last, "Perl", 5)]
    recents = spark.createDataFrame(data, "batch_time TIMESTAMP, language STRING, recents BIGINT")
    panel = dashboard.recents_panel(recents, ["Python", "C"], others=True)
    assert panel.count() == 40 and panel.agg(F.min("label")).first()[0] == "10:02:00"
    perl = panel.where("Language = 'Perl' AND Recents > 0")
    assert rows_of(perl, "label", "Recents") == [("10:11:00", 5)]
    assert panel.where("Language = 'Shell'").agg(F.sum("Recents")).first()[0] == 0


def test_printed_batches(spark, capsys):
    now = datetime(2024, 3, 1, 10, tzinfo=timezone.utc)
    console.show_batch("totals", now, spark.range(1))
    console.show_batch("totals", now, spark.range(0))
    console.preview(2)(spark.range(5), 7)
    out = capsys.readouterr().out
    assert "totals | batch 2024-03-01 10:00:00 | epoch 1709287200" in out
    assert console.NOTHING in out and "batch 7" in out and "only showing top 2 rows" in out


def test_old_snapshots_are_found_and_forgotten_by_name(spark, folder):
    assert tables.batch_numbers(spark, f"{folder}/none") == []
    assert tables.latest_batch(spark, f"{folder}/none", "id BIGINT").count() == 0
    for batch_id in (9, 10, 11):
        tables.write_batch(spark.range(batch_id), f"{folder}/t", batch_id)
    assert tables.batch_numbers(spark, f"{folder}/t") == [9, 10, 11]
    tables.forget_batches(spark, f"{folder}/t", 11)
    assert tables.batch_numbers(spark, f"{folder}/t") == [11]
    assert tables.latest_batch(spark, f"{folder}/t", "id BIGINT").count() == 11
