"""Random rows, with a key that holds about a third of them, against plain Python."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from repotide.operators import dedup, filters, metrics, ranking

SCHEMA = "seq BIGINT, batch INT, id BIGINT, language STRING, pushed_at TIMESTAMP, stargazers_count BIGINT"
START = datetime(2024, 3, 1, 12)

rows = st.lists(
    st.tuples(
        st.integers(0, 2),
        st.one_of(st.just(0), st.integers(0, 9), st.integers(0, 9)),
        st.sampled_from(["Python", "Java", "C", None]),
        st.integers(0, 200).map(lambda s: START + timedelta(seconds=s)),
        st.integers(0, 1000),
    ),
    min_size=1,
    max_size=60,
).map(lambda values: [(i, *value) for i, value in enumerate(values)])

few = settings(max_examples=6, deadline=None)


@few
@given(rows)
def test_accepted_and_rejected_rows(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    winners = {}
    for row in data:
        if row[3] is not None:
            winners.setdefault(row[2], row[0])
    known = filters.with_language(df)
    kept = sorted(((seq,) for seq in winners.values()), key=repr)
    assert rows_of(dedup.first_seen(known, ["id"], "seq"), "seq") == kept
    assert rows_of(dedup.first_seen_wide(known, ["id"], "seq"), "seq") == kept
    others = [
        (row[0], dedup.NO_LANGUAGE if row[3] is None else dedup.DUPLICATE)
        for row in data
        if row[0] not in winners.values()
    ]
    assert rows_of(dedup.rejected_rows(df, "id", "seq"), "seq", "reason") == sorted(others, key=repr)


@few
@given(rows)
def test_recent_counts(spark, data):
    now = START + timedelta(seconds=150)
    newest = {}
    for _, batch, id_, language, pushed, _ in data:
        if language is None:
            continue
        key = (batch, language, id_)
        newest[key] = max(pushed, newest.get(key, pushed))
    expected = Counter()
    for (batch, language, _), pushed in newest.items():
        expected[batch, language] += pushed >= now - timedelta(seconds=60)
    got = metrics.recent_counts(spark.createDataFrame(data, SCHEMA), ["batch"], F.lit(now))
    assert rows_of(got) == sorted(((*key, n) for key, n in expected.items()), key=repr)


@few
@given(rows)
def test_averages(spark, data):
    count, stars = Counter(), Counter()
    for row in data:
        count[row[3]] += 1
        stars[row[3]] += row[5]
    got = metrics.average_stars(metrics.star_totals(spark.createDataFrame(data, SCHEMA)))
    assert rows_of(got) == sorted(((k, stars[k] / count[k]) for k in count), key=repr)


@few
@given(rows, st.integers(1, 5))
def test_latest_page(spark, data, size):
    newest = {}
    for _, batch, id_, language, pushed, _ in data:
        if language is None:
            continue
        key = (batch, language, id_)
        newest[key] = max(pushed, newest.get(key, pushed))
    pages = {}
    for (batch, language, id_), pushed in newest.items():
        pages.setdefault((batch, language), []).append((-pushed.timestamp(), id_))
    expected = [
        (*key, id_, rank)
        for key, page in pages.items()
        for rank, (_, id_) in enumerate(sorted(page)[:size], 1)
    ]
    got = dedup.latest_page(spark.createDataFrame(data, SCHEMA), "batch", size)
    assert rows_of(got, "batch", "language", "id", "rank") == sorted(expected, key=repr)


@few
@given(rows, st.integers(1, 4))
def test_last_values(spark, data, n):
    by_key = {}
    for row in data:
        by_key.setdefault(row[3], []).append(row[0])
    expected = [(k, seq) for k, seqs in by_key.items() for seq in sorted(seqs)[-n:]]
    got = ranking.last_values(spark.createDataFrame(data, SCHEMA), "language", "seq", n)
    assert rows_of(got, "language", "seq") == sorted(expected, key=repr)
