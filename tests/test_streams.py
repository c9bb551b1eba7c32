"""Streams over files that arrive one by one, against the batch result over all of them."""

import os
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from repotide.operators import dedup, filters, metrics, ranking
from repotide.session import ROCKSDB, prepare, run_dir, settings, shared_dir
from repotide.sinks import console, dashboard, tables
from repotide.sinks.console import NOTHING
from repotide.streaming import state
from repotide.streaming.app import (
    HISTORY,
    NewRepos,
    Recents,
    latest_dashboard,
    rejects,
    run_report_of,
    start_repo_analytics,
    top_panel,
)
from repotide.streaming.intake import PENDING, accepted_rows, arrivals, intake_table, start_intake
from repotide.streaming.labels import start_bucket_analytics, start_number_analytics
from repotide.streaming.queries import finish, start, start_table, to_table

REPOS = (
    "seq BIGINT, id BIGINT, language STRING, pushed_at TIMESTAMP, stargazers_count BIGINT, "
    "description STRING"
)
NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
LANGUAGES = ["Python", "Java", "C", None]


def made_rows(n=240):
    """Rows where a third is one repository, whose stars, language and text keep changing."""
    rows = []
    for seq in range(n):
        id_ = 0 if seq % 3 == 0 else seq % 50
        text = " ".join(f"w{chr(97 + (seq * k) % 23)}" for k in range(1, 6)) if seq % 11 else None
        rows.append(
            (seq, id_, LANGUAGES[(seq // 7) % 4], NOON + timedelta(seconds=seq - 120), seq, text)
        )
    return rows


def drop_file(spark, folder, number, rows, schema=REPOS):
    """Let one more file arrive; later files get later times."""
    import pyarrow.parquet as pq

    frame = spark.createDataFrame(rows, schema)
    target = f"{folder}/part-{number:03d}.parquet"
    pq.write_table(frame.toArrow(), target)
    os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


def arrive(spark, folder, rows, files, schema=REPOS, first=0):
    os.makedirs(folder, exist_ok=True)
    size = -(-len(rows) // files)
    for i in range(files):
        drop_file(spark, folder, first + i, rows[i * size:(i + 1) * size], schema)


def stream(spark, folder, schema=REPOS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def batch_of(spark, rows, schema=REPOS):
    return spark.createDataFrame(rows, schema)


def accepted(spark, rows):
    return dedup.first_seen(filters.countable(batch_of(spark, rows)), ["id"], "seq")


def in_two_runs(spark, folder, rows, run, schema=REPOS):
    """Two files, a run to the end, two more files, and another run on the same checkpoint."""
    half = len(rows) // 2
    arrive(spark, f"{folder}/in", rows[:half], 2, schema)
    finish(run())
    arrive(spark, f"{folder}/in", rows[half:], 2, schema, first=2)
    finish(run())


def test_running_totals_survive_a_restart(spark, folder):
    rows = made_rows()

    def run():
        once = state.first_seen_updates(
            stream(spark, f"{folder}/in"), "id", "seq", ["language", "stargazers_count"]
        )
        return start(once, state.add_new_rows(f"{folder}/out"), f"{folder}/checkpoint")

    in_two_runs(spark, folder, rows, run)
    last = tables.latest_batch(spark, f"{folder}/out", state.RUNNING_TOTALS)
    assert rows_of(last) == rows_of(metrics.star_totals(accepted(spark, rows)))
    written = tables.read_batches(spark, f"{folder}/out", state.RUNNING_TOTALS)
    assert written.select("batch_id").distinct().count() == 4


def test_null_languages_and_keys_count_alike_in_batch_and_stream(spark, folder):
    rows = [(0, 7, None, NOON, 9, "x"), (1, 7, "C", NOON, 4, "x"), (2, None, "C", NOON, 5, "x"), (3, 8, "C", NOON, 4, None)]
    arrive(spark, f"{folder}/in", rows, 2)
    source = stream(spark, f"{folder}/in")
    once = state.first_seen_updates(source, "id", "seq", ["language", "stargazers_count"])
    finish(start(once, state.add_new_rows(f"{folder}/out"), f"{folder}/c"))
    last = tables.latest_batch(spark, f"{folder}/out", state.RUNNING_TOTALS)
    assert rows_of(last) == [("C", 2, 8)]
    words = metrics.word_counts(batch_of(spark, rows))
    assert rows_of(words) == [("C", "x", 2)]


def test_top_words_from_changed_words_only(spark, folder):
    rows = made_rows()

    def run():
        counts = metrics.word_counts(stream(spark, f"{folder}/in"))
        return start(counts, state.keep_top_words(f"{folder}/out"), f"{folder}/checkpoint")

    in_two_runs(spark, folder, rows, run)
    for batch_id, seen in ((1, 120), (3, 240)):
        top = tables.read_batch(spark, f"{folder}/out", batch_id, state.RANKED)
        expected = ranking.ranked_words(metrics.word_counts(batch_of(spark, rows[:seen])))
        assert rows_of(top.select(*expected.columns)) == rows_of(expected)


def test_top_words_with_many_changes_per_batch(spark, folder):
    """Words rise, fall behind and tie over many batches; the list is checked after each."""
    counts = Counter()
    on_batch = state.keep_top_words(folder, n=3)
    for batch_id in range(6):
        new = [("C", f"w{(i * i + batch_id * 3) % 11}") for i in range(2 + batch_id * 3)]
        counts.update(new)
        changed = [(*key, counts[key]) for key in set(new)]
        on_batch(spark.createDataFrame(changed, "language STRING, word STRING, freq BIGINT"), batch_id)
        best = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:3]
        expected = [(word, freq, rank) for rank, ((_, word), freq) in enumerate(best, 1)]
        got = tables.read_batch(spark, folder, batch_id, state.RANKED)
        assert rows_of(got, "word", "freq", "rank") == sorted(expected, key=repr)


def test_fold_with_tasks_that_have_no_rows(spark, folder):
    """The first file has no row with a key, the last one has few."""
    schema = "key STRING, value BIGINT"
    rows = [(None, 2), (None, 3), ("a", None), (None, 5), ("a", 2), ("b", 3), ("a", 5), (None, 7)]
    arrive(spark, f"{folder}/in", rows, 2, schema)
    folded = state.fold(stream(spark, f"{folder}/in", schema), "key", "value", lambda v: v + 1, lambda a, b: a * b)
    finish(start(folded, to_table(f"{folder}/out"), f"{folder}/c"))
    assert rows_of(tables.read_batches(spark, f"{folder}/out", schema)) == [("a", 18, 1), ("b", 4, 1)]


def test_running_counts_show_every_key_in_every_batch(spark, folder):
    rows = [(v,) for v in (9, 18, 27, 36, 1, 2, 3, 4)]

    def run():
        counts = state.running_divisible(stream(spark, f"{folder}/in", "value BIGINT"))
        return start(counts.orderBy("count"), to_table(f"{folder}/out"), f"{folder}/c", "complete")

    in_two_runs(spark, folder, rows, run, "value BIGINT")
    written = tables.read_batches(spark, f"{folder}/out", "isMultipleOf9 STRING, count BIGINT")
    assert rows_of(written) == sorted(
        [("Yes", 2, 0), ("Yes", 4, 1), ("Yes", 4, 2), ("Yes", 4, 3), ("No", 2, 2), ("No", 4, 3)],
        key=repr,
    )


@pytest.mark.parametrize("slide", [None, 10])
def test_windowed_counts(spark, folder, slide):
    rows = [(NOON + timedelta(seconds=7 * i), i) for i in range(40)]
    schema = "ts TIMESTAMP, value BIGINT"

    def counts(source):
        label = metrics.divisible_label(F.col("value")).alias("label")
        return state.windowed_counts(source.select("ts", label), "ts", "label", slide=slide).select(
            F.col("window.start").alias("start"), "label", "count"
        )

    def run():
        return start(
            counts(stream(spark, f"{folder}/in", schema)), to_table(f"{folder}/out"), f"{folder}/c"
        )

    in_two_runs(spark, folder, rows, run, schema)
    written = tables.read_batches(
        spark, f"{folder}/out", "start TIMESTAMP, label STRING, count BIGINT"
    )
    newest = ranking.newest_by_key(written, ["start", "label"], "batch_id")
    assert rows_of(newest) == rows_of(counts(batch_of(spark, rows, schema)))


def test_a_lateness_bound_lets_windows_close(spark, folder):
    rows = [(NOON + timedelta(seconds=30 * i),) for i in range(20)]
    arrive(spark, f"{folder}/in", rows, 4, "ts TIMESTAMP")
    counts = state.windowed_counts(stream(spark, f"{folder}/in", "ts TIMESTAMP"), "ts", lateness="1 minute")
    finish(start(counts.select("window.start", "count"), to_table(f"{folder}/out"), f"{folder}/c", "append"))
    closed = tables.read_batches(spark, f"{folder}/out", "start TIMESTAMP, count BIGINT")
    assert 0 < closed.count() < 20 and closed.agg(F.max("count")).first()[0] == 1


def test_distinct_rows_survive_a_restart(spark, folder):
    rows = [(i % 30,) for i in range(120)]

    def run():
        once = state.distinct_rows(stream(spark, f"{folder}/in", "id BIGINT"), ["id"])
        return start(once, to_table(f"{folder}/out"), f"{folder}/c", "append")

    in_two_runs(spark, folder, rows, run, "id BIGINT")
    assert rows_of(tables.read_batches(spark, f"{folder}/out", "id BIGINT").select("id")) == sorted(
        ((i,) for i in range(30)), key=repr
    )


def test_distinct_rows_with_bounded_state(spark, folder):
    rows = [(i % 5, NOON + timedelta(seconds=i)) for i in range(40)]
    arrive(spark, f"{folder}/in", rows, 2, "id BIGINT, ts TIMESTAMP")
    once = state.distinct_rows(
        stream(spark, f"{folder}/in", "id BIGINT, ts TIMESTAMP"), ["id"], lateness=("ts", "1 hour")
    )
    finish(start(once, to_table(f"{folder}/out"), f"{folder}/c", "append"))
    assert tables.read_batches(spark, f"{folder}/out", "id BIGINT").count() == 5


FOLDS = {
    "count": (lambda v: 1, lambda a, b: a + b, F.count),
    "max": (lambda v: v, max, F.max),
    "xor": (lambda v: v * 2 + 1, lambda a, b: a ^ b, lambda c: F.bit_xor(F.col(c) * 2 + 1)),
}


@pytest.mark.parametrize("how", sorted(FOLDS))
@pytest.mark.parametrize("partitions, arrow_rows", [(1, 10_000), (8, 7)])
def test_fold_with_own_functions(spark, folder, how, partitions, arrow_rows):
    rows = [(f"k{i % 3}", i) for i in range(1000)] + [(None, 5), ("k0", None)]
    schema = "k STRING, v BIGINT"
    lift, merge, same = FOLDS[how]

    def run():
        source = stream(spark, f"{folder}/in", schema).repartition(partitions)
        totals = state.fold(source, "k", "v", lift, merge)
        return start(totals, to_table(f"{folder}/out"), f"{folder}/c")

    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=arrow_rows):
        in_two_runs(spark, folder, rows, run, schema)
    written = tables.read_batches(spark, f"{folder}/out", "key STRING, value BIGINT")
    expected = batch_of(spark, rows, schema).dropna().groupBy("k").agg(same("v"))
    assert rows_of(ranking.newest_by_key(written, ["key"], "batch_id")) == rows_of(expected)


# Exact intake ------------------------------------------------------------------------------------------


class Done:
    """All queries of a run as one."""

    def __init__(self, queries):
        self.queries = queries

    def awaitTermination(self):
        for query in self.queries:
            finish(query)


def take_in(spark, folder, **more):
    return Done(start_intake(stream(spark, f"{folder}/in"), "id", "seq", f"{folder}/out", f"{folder}/c", **more))


def taken_in(spark, folder):
    return intake_table(spark, f"{folder}/out", REPOS, "id")


def test_intake_equals_the_batch_result(spark, folder):
    rows = made_rows() + [(900, None, "C", NOON, 1, "x"), (901, None, None, None, None, None)]
    in_two_runs(spark, folder, rows, lambda: take_in(spark, folder))
    table = taken_in(spark, folder)
    whole = ["seq", "id", "language", "pushed_at", "stargazers_count", "description"]
    assert rows_of(accepted_rows(table), *whole) == rows_of(accepted(spark, rows), *whole)
    rejected = dedup.rejected_rows(batch_of(spark, rows), "id", "seq")
    assert rows_of(table.where("not accepted"), *whole, "reason") == rows_of(rejected, *whole, "reason")
    assert {r.reason for r in rejected.collect()} == {"no language", "no key", "duplicate"}


def test_equal_rows_are_accepted_once(spark, folder):
    arrive(spark, f"{folder}/in", [(0, 1, "C", NOON, 1, "x")] * 3, 1)
    finish(take_in(spark, folder, retention="7d"))
    assert rows_of(taken_in(spark, folder), "accepted", "reason") == [(False, "duplicate")] * 2 + [(True, None)]


def test_rows_not_read_yet_are_pending(spark, folder):
    rows = made_rows(60)
    arrive(spark, f"{folder}/in", rows[:30], 1)
    finish(take_in(spark, folder))
    # The second half is taken in, but the query for new keys has not run on it.
    arrive(spark, f"{folder}/in", rows[30:], 1, first=1)
    stamped = stream(spark, f"{folder}/in").withColumn("taken", F.unix_millis(F.current_timestamp()))
    finish(start_table(stamped, f"{folder}/out/arrivals", f"{folder}/c/arrivals", ["taken"]))
    found = taken_in(spark, folder)
    assert found.count() == 60
    late = rows_of(found.where("seq >= 30"), "seq", "reason")
    assert late == sorted(((r[0], PENDING if r[2] else "no language") for r in rows[30:]), key=repr)
    finish(take_in(spark, folder))
    assert rows_of(accepted_rows(taken_in(spark, folder)), "seq") == rows_of(accepted(spark, rows), "seq")


def test_the_intake_holds_no_text_and_runs_no_python(spark, folder):
    arrive(spark, f"{folder}/in", made_rows(20), 1)
    done = take_in(spark, folder)
    for query in done.queries:
        finish(query)
        plan = query._jsq.explainInternal(False)
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    seen = done.queries[1]._jsq.explainInternal(False)
    assert "description" not in seen and "stargazers_count" not in seen and "StateStoreSave" in seen


def test_a_repeated_batch_of_new_rows_changes_nothing(spark, folder):
    rows, calls = made_rows(), []
    new_repos = NewRepos(f"{folder}/out")

    def twice(new, batch_id):
        calls.append(batch_id)
        new_repos(new, batch_id)
        new_repos(new, batch_id)

    in_two_runs(spark, folder, rows, lambda: take_in(spark, folder, payload=["language", "stargazers_count"], on_new=twice))
    assert len(calls) > 1
    once = accepted(spark, rows)
    totals = tables.latest_batch(spark, f"{folder}/out/totals", state.RUNNING_TOTALS)
    assert rows_of(totals) == rows_of(metrics.star_totals(once))
    words = tables.read_batches(spark, f"{folder}/out/new_words", "language STRING, word STRING, freq BIGINT")
    assert rows_of(words.groupBy("language", "word").agg(F.sum("freq"))) == rows_of(metrics.word_counts(once))
    assert [n for n in os.listdir(f"{folder}/out/new_words") if n.startswith("_staged")] == []


def test_large_numbers_and_nulls_come_back_exactly(spark, folder):
    big = 2**62 + 1
    rows = [(big, big, "C", NOON, None, None), (big + 1, big + 2, "C", None, big, "x")]
    arrive(spark, f"{folder}/in", rows, 1)
    finish(take_in(spark, folder))
    table = accepted_rows(taken_in(spark, folder))
    assert rows_of(table, "seq", "id", "stargazers_count", "description") == [
        (big, big, None, None), (big + 1, big + 2, big, "x")]


# Application ----------------------------------------------------------------------------------------------


def expected_dashboard(spark, rows):
    once = accepted(spark, rows)
    totals = metrics.star_totals(once)
    return (
        rows_of(dashboard.totals_panel(totals)),
        rows_of(dashboard.stars_panel(metrics.average_stars(totals))),
        rows_of(ranking.word_lists(ranking.ranked_words(metrics.word_counts(once)))),
    )


def shown_dashboard(spark, out):
    shown = latest_dashboard(spark, out)
    return tuple(rows_of(shown[name]) for name in (tables.COUNTS, tables.STARS, tables.TOP))


def plain_recents(rows, now):
    """Newest push per repository and language of one batch, in plain Python."""
    newest = {}
    for _, id_, language, pushed, _, _ in rows:
        if language is not None:
            newest[language, id_] = max(pushed, newest.get((language, id_), pushed))
    found = Counter({language: 0 for language, _ in newest})
    for (language, _), pushed in newest.items():
        found[language] += pushed >= now - timedelta(seconds=60)
    return found


def clock(batch_id):
    return NOON + timedelta(seconds=60 * (batch_id - 1))


def stamped(spark, folder):
    """Rows of made_rows() with the time of their file, sixty rows to a file."""
    number = F.floor(F.col("seq") / 60).cast("int")
    return stream(spark, f"{folder}/in").withColumn(
        "batch_time", F.timestamp_seconds(F.lit(int(clock(0).timestamp())) + number * 60)
    )


def analyse(source, folder, **options):
    return Done(start_repo_analytics(source, f"{folder}/out", f"{folder}/c", None, **options))


def test_application_over_a_restart(spark, folder, capsys):
    rows = made_rows()
    in_two_runs(spark, folder, rows, lambda: analyse(stamped(spark, folder), folder, quiet=False))
    assert shown_dashboard(spark, f"{folder}/out") == expected_dashboard(spark, rows)
    history = tables.latest_batch(spark, f"{folder}/out/history", HISTORY)
    expected = [
        (clock(i).replace(tzinfo=None), language, n)
        for i in range(4)
        for language, n in plain_recents(rows[i * 60:(i + 1) * 60], clock(i)).items()
    ]
    assert rows_of(history, "batch_time", "Language", "Recents") == sorted(expected, key=repr)
    panel = latest_dashboard(spark, f"{folder}/out")[tables.RECENTS]
    assert panel.count() == 12
    rejected = rejects(spark, f"{folder}/out", REPOS)
    assert rows_of(rejected, "seq", "reason") == rows_of(
        dedup.rejected_rows(batch_of(spark, rows), "id", "seq"), "seq", "reason"
    )
    printed = capsys.readouterr().out
    assert "dash_top10 | batch" in printed and "dash_recents" in printed


def test_recents_repeat_a_batch_without_change(spark, folder):
    rows = [(*r, clock(r[0] // 60)) for r in made_rows(180)]
    recents = Recents(folder)
    for batch_id, part in ((0, rows[:60]), (1, rows[60:120]), (1, rows[60:120]), (2, rows[120:]), (2, rows[120:])):
        recents(batch_of(spark, part, f"{REPOS}, batch_time TIMESTAMP"), batch_id)
    history = tables.latest_batch(spark, f"{folder}/history", HISTORY)
    assert rows_of(history, "batch_time", "Language", "Recents") == sorted(
        ((clock(i).replace(tzinfo=None), language, n)
         for i in range(3) for language, n in plain_recents([r[:6] for r in rows[i * 60:(i + 1) * 60]], clock(i)).items()),
        key=repr,
    )


def test_results_of_an_empty_batch(spark, folder, capsys):
    arrive(spark, f"{folder}/in", [(0, None, "C", NOON, 1, "x")], 1)
    finish(take_in(spark, folder, payload=["language", "stargazers_count"], on_new=NewRepos(f"{folder}/out", quiet=False)))
    Recents(folder, quiet=False)(batch_of(spark, [], f"{REPOS}, batch_time TIMESTAMP"), 0)
    assert capsys.readouterr().out.count(NOTHING) == 3
    assert arrivals(spark, f"{folder}/out", REPOS).count() == 1


def test_every_ranked_word_is_printed(spark, folder, capsys):
    counts = [(l, f"{l}word{i:02d}", 100 - i) for l in ("Python", "Java", "C") for i in range(12)]
    top_panel(folder, quiet=False)(spark.createDataFrame(counts, "language STRING, word STRING, freq BIGINT"), 0)
    console.show_batch("long", NOON, spark.range(35).select((F.col("id") + 1000).alias("n")))
    out = capsys.readouterr().out
    assert all(f"{l}word{i:02d}" in out for l in ("Python", "Java", "C") for i in range(10))
    assert all(str(1000 + i) in out for i in range(35)) and "only showing" not in out


def test_interval_trigger(spark, folder):
    arrive(spark, f"{folder}/in", made_rows(20), 1)
    queries = start_repo_analytics(
        stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/c", every_seconds=1
    )
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert shown_dashboard(spark, f"{folder}/out") == expected_dashboard(spark, made_rows(20))


def test_recency_at_the_logged_batch_time(spark, folder):
    now = datetime.now(timezone.utc)
    rows = [
        (0, 1, "C", now + timedelta(hours=1), 1, "x"),
        (1, 2, "C", now - timedelta(hours=1), 1, "x"),
        (2, 3, "Go", now - timedelta(hours=1), 1, "x"),
    ]
    arrive(spark, f"{folder}/in", rows, 1)
    finish(analyse(stream(spark, f"{folder}/in"), folder))
    recents = tables.latest_batch(spark, f"{folder}/out/history", HISTORY)
    assert rows_of(recents, "Language", "Recents") == [("C", 1), ("Go", 0)]
    times = [r.batch_time for r in recents.select("batch_time").distinct().collect()]
    assert len(times) == 1 and times[0].timestamp() > now.timestamp() - 1


def test_a_batch_costs_the_same_however_long_the_history(spark, folder):
    """Rows read and state rows looked at by the later of many equal batches stay level."""
    rows = [(i, i, "C", NOON, i, f"wa{i % 7} wb{i % 5}") for i in range(20 * 60)]
    arrive(spark, f"{folder}/in", rows, 20)
    done = analyse(stream(spark, f"{folder}/in"), folder)
    finish(done)
    for query in done.queries:
        read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert len(read) >= 1 and max(read) <= 1.2 * min(read)
    kept = [tables.batch_numbers(spark, f"{folder}/out/{name}") for name in ("totals", "history", tables.COUNTS)]
    assert all(len(numbers) <= state.SNAPSHOTS + 1 for numbers in kept)


# Set-up ------------------------------------------------------------------------------------------------------


def test_folders_come_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark)).rstrip("/")
    assert run_dir(spark, "x") != run_dir(spark, "x")
    assert run_dir(spark, "x").startswith(shared_dir(spark))


def test_options_of_the_caller_stay_as_they_are(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    with settings(spark, spark__sql__session__timeZone="Asia/Tokyo", spark__sql__shuffle__partitions=3):
        own = prepare(spark, "/root/testdata/sf0.001" if os.path.isdir("/root/testdata") else None)
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        assert own.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert spark.conf.get("spark.sql.session.timeZone") == zone


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_rows_are_combined_before_the_state(spark, folder):
    """Both the first-seen state and the word state get partial results, not raw rows."""
    arrive(spark, f"{folder}/in", made_rows(20), 1)
    source = filters.with_language(stream(spark, f"{folder}/in"))
    for i, rows in enumerate(
        (state.first_seen_updates(source, "id", "seq", ["language"]), metrics.word_counts(source))
    ):
        query = start(rows, to_table(f"{folder}/out{i}"), f"{folder}/c{i}")
        finish(query)
        plan = query._jsq.explainInternal(False)
        before_exchange = plan[plan.rindex("Exchange hashpartitioning"):]
        assert "partial_" in before_exchange


def test_settings_are_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        assert spark.conf.get(name) == ROCKSDB
    assert spark.conf.get(name) == before


def test_adaptive_execution_is_on_inside_a_batch(spark, folder):
    arrive(spark, f"{folder}/in", made_rows(10), 1)
    seen = []

    def look(batch, batch_id):
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        seen.append("AdaptiveSparkPlan" in plan_of(batch.groupBy("id").count()))

    finish(start(stream(spark, f"{folder}/in"), look, f"{folder}/c", "append"))
    assert seen == ["true", True]


# Smaller programs --------------------------------------------------------------------------------------------


def test_number_program(spark, folder, capsys):
    rows = [(NOON + timedelta(seconds=i), i * 3) for i in range(300)]
    arrive(spark, f"{folder}/in", rows, 5, "ts TIMESTAMP, value BIGINT")
    queries = start_number_analytics(
        stream(spark, f"{folder}/in", "ts TIMESTAMP, value BIGINT"), f"{folder}/out", f"{folder}/c", None
    )
    for query in queries:
        finish(query)
    running = tables.latest_batch(spark, f"{folder}/out/running", "isMultipleOf9 STRING, count BIGINT")
    assert rows_of(running) == [("No", 200), ("Yes", 100)]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in queries[1].recentProgress]
    assert max(held) <= 16
    windows = tables.read_batches(spark, f"{folder}/out/windows", "start TIMESTAMP, isMultipleOf9 STRING, count BIGINT")
    # A window is written once, when it can get no more rows.
    per_window = windows.groupBy("start").agg(F.sum("count").alias("n"))
    assert rows_of(per_window.select("n")) == [(20,)] * per_window.count()
    assert "isMultipleOf9" in capsys.readouterr().out


def test_bucket_program(spark, folder):
    now = datetime.now(timezone.utc)
    rows = [("python", now), ("JAVA", now - timedelta(days=1)), ("Go", now), (None, now - timedelta(days=1))]
    arrive(spark, f"{folder}/in", rows, 2, "language STRING, pushed_at TIMESTAMP")
    queries = start_bucket_analytics(
        stream(spark, f"{folder}/in", "language STRING, pushed_at TIMESTAMP"), f"{folder}/out", f"{folder}/c", None
    )
    for query in queries:
        finish(query)
    buckets = tables.latest_batch(spark, f"{folder}/out/buckets", "lang STRING, count BIGINT")
    assert rows_of(buckets) == [("C", 2), ("Java", 1), ("Python", 1)]
    ages = tables.read_batches(spark, f"{folder}/out/ages", "label STRING, count BIGINT")
    assert rows_of(ages.groupBy("label").agg(F.sum("count"))) == [("old", 2), ("recent", 2)]


def test_report_of_a_run(spark, folder):
    arrive(spark, f"{folder}/in", [(0, 1, "C", NOON, 4, "b a a"), (1, 2, "C", NOON, 1, None)], 1)
    finish(analyse(stream(spark, f"{folder}/in"), folder))
    lines = run_report_of(spark, f"{folder}/out", 10, 20, ["C", "Go"]).orderBy("line_no")
    assert [r.line for r in lines.collect()] == ["10:20", "C:2:2.5", "Go:0:0.0", "C:(a,2),(b,1)", "Go:"]


def test_folders_can_be_swept(spark, monkeypatch):
    from repotide import session

    monkeypatch.setattr(session, "_made", [])
    with session.folders_made() as made:
        paths = [run_dir(spark, "x") for _ in range(3)]
        for path in paths:
            spark.range(2).write.parquet(path)
        session.remove_folder(spark, paths[0])
    assert made == paths[1:] and not os.path.exists(paths[0]) and all(map(os.path.isdir, made))
    session.sweep(spark)
    session.sweep(spark)
    assert not any(map(os.path.exists, paths))
