"""Top words by a sketch and exact counts of its candidates, against counting all words."""

import random

import pytest

from conftest import rows_of
from repotide.operators import metrics, ranking
from repotide.sinks import tables
from repotide.streaming import sketch
from repotide.streaming.queries import finish, start
from test_streams import NOON, REPOS, arrive, batch_of, in_two_runs, stream


def letters(i):
    return "".join(chr(97 + (i // 26**k) % 26) for k in range(3))


def documents(n, words, seed=1):
    rng = random.Random(seed)
    pool = [letters(i) for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [
        (i, i, rng.choice(["Python", "C", None]), NOON, 1, " ".join(rng.choices(pool, weights, k=12)) if i % 9 else None)
        for i in range(n)
    ]


def kept(spark, folder, **how):
    keep = sketch.keep_candidates(f"{folder}/out", **how)
    return start(stream(spark, f"{folder}/in"), keep, f"{folder}/c", "append")


@pytest.mark.parametrize("width, candidates, widened", [(4096, 100, []), (16, 12, ["C", "Python"])])
def test_equals_counting_all_words(spark, folder, width, candidates, widened):
    rows = documents(240, 400)
    in_two_runs(spark, folder, rows, lambda: kept(spark, folder, width=width, candidates=candidates))
    top, names = sketch.top_words_of(batch_of(spark, rows), f"{folder}/out", width=width)
    assert rows_of(top) == rows_of(ranking.ranked_words(metrics.word_counts(batch_of(spark, rows))))
    assert names == widened


def test_few_words_and_none(spark, folder):
    rows = [(0, 0, "C", NOON, 1, "b a a"), (1, 1, "C", NOON, 1, None), (2, 2, None, NOON, 1, "x")]
    arrive(spark, f"{folder}/in", rows, 3)
    finish(kept(spark, folder))
    top, names = sketch.top_words_of(batch_of(spark, rows), f"{folder}/out")
    assert rows_of(top, "word", "freq") == [("a", 2), ("b", 1)] and names == []


def test_what_is_kept_stays_level(spark, folder):
    rows = documents(400, 2000, seed=4)
    arrive(spark, f"{folder}/in", rows, 20)
    finish(kept(spark, folder, width=64, candidates=20))
    for name, schema, most in (("cells", sketch.CELLS, 2 * sketch.DEPTH * 64), ("listed", sketch.LISTED, 40), ("dropped", sketch.DROPPED, 2)):
        sizes = [tables.read_batch(spark, f"{folder}/out/{name}", b, schema).count() for b in tables.batch_numbers(spark, f"{folder}/out/{name}")]
        assert len(sizes) == 11 and max(sizes) <= most


def test_estimates_are_never_below_the_counts(spark):
    counts = spark.createDataFrame([("C", letters(i), 1 + i % 40) for i in range(500)], "language STRING, word STRING, freq BIGINT")
    cells = sketch.merged(sketch.sketch_of(counts, 128), sketch.sketch_of(counts, 128))
    found = sketch.estimates(counts.select("language", "word"), cells, 128).join(counts, ["language", "word"])
    assert found.count() == 500 and found.where("estimate < 2 * freq").count() == 0
