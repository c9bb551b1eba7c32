"""Near-duplicate operators against comparing all pairs."""

import itertools
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from repotide.llm import minhash, paragraphs
from repotide.llm.common import Forest
from repotide.llm.components import components

WORDS = [f"w{i}" for i in range(200)]
DOCS = "doc_id BIGINT, text STRING, class STRING, n BIGINT"


def text(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def edited(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def corpus(seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = text(rng, rng.choice([30, 80, 200]))
        rows += [edited(rng, base, rng.choice([0, 1, 2, 4, 8])) for _ in range(rng.choice([1, 3, 9]))]
    phrase = "over and over again we go "
    rows += [phrase * 9, phrase * 10, phrase * 30, "tiny text", "Tiny  TEXT!", "one", "", "?!", None, None]
    return [(i * 3, t) for i, t in enumerate(rows)]


def runs(words):
    if len(words) < 5:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def tokens(value):
    cleaned = "".join(c.lower() if c.isalnum() else " " for c in value or "")
    return cleaned.split()


def probability(a, b):
    x, y = ({s: 1 + np.log(v.count(s)) for s in set(v)} for v in (a, b))
    common = set(x) & set(y)
    total = 0.0
    for i in common:
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in set(x) | set(y))
    return total


def groups(n, pairs):
    forest = Forest(n)
    for a, b in pairs:
        forest.join(a, b)
    return [forest.root(i) for i in range(n)]


@pytest.mark.parametrize("block", [1024, 3])
def test_near_duplicates_equal_all_pairs(spark, block):
    rows = corpus()
    shingled = [runs(tokens(t)) for _, t in rows]
    alike = [
        (i, j)
        for i, j in itertools.combinations(range(len(rows)), 2)
        if shingled[i] and shingled[j] and probability(shingled[i], shingled[j]) >= 0.8
    ]
    expected = groups(len(rows), alike)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(5)
    found = {r["doc_id"]: r for r in minhash.near_duplicates(docs, block=block).collect()}
    assert {i: found[i]["cluster_id"] for i, _ in rows} == {
        rows[k][0]: rows[root][0] for k, root in enumerate(expected)
    }
    assert all(r["kept"] == (r["doc_id"] == r["cluster_id"]) for r in found.values())
    assert len(set(expected)) < len(rows) - 10


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, "same five words are here", "a", 1)] * 2 + [(None, "same five words are here", None, None)]
    rows += [(2, "Same five words ARE here.", "b", 2), (2, "something else that is long enough", "c", 3), (7, None, "d", 4)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 6
    assert sorted((r["doc_id"], r["cluster_id"]) for r in found if r["doc_id"] is not None) == [
        (2, 2), (2, 2), (5, 2), (5, 2), (7, 7)]
    assert sorted((r["doc_id"], r["kept"]) for r in found if r["doc_id"] is not None) == [
        (2, True), (2, True), (5, False), (5, False), (7, True)]
    assert [(r["cluster_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, np.uint64) for n in (300, 60, 60))
    weights = {int(h): w for h, w in zip(common, 1 + rng.random(300) * 3)}
    sets = [np.sort(np.concatenate([common, own])) for own in (a, b)]
    values = [np.array([weights.get(int(h), 1.0) for h in s]) for s in sets]
    signed = minhash.signatures(
        np.concatenate(sets), np.concatenate(values), np.array([0, 360, 720]), 4096
    )
    exact = minhash.probability_jaccard((sets[0], values[0]), (sets[1], values[1]))
    assert abs((signed[0] == signed[1]).mean() - exact) < 0.03


def test_hot_bucket_is_linked_and_spread(spark):
    rng = random.Random(5)
    base = text(rng, 150)
    rows = [(i, edited(rng, base, 1), "h", 1) for i in range(300)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), block=64).collect()
    assert {r["cluster_id"] for r in found} == {0}


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(sys.modules[components.__module__], "FEW", few)
    edges = [(1, 2), (2, 3), (5, 4), (4, 4), (9, 8), (8, 7), (7, 9), (None, 1), (20, 3)]
    edges += [(i, i + 1) for i in range(100, 160)]
    found = components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"))
    assert {r["node"]: r["component"] for r in found.collect()} == {
        1: 1, 2: 1, 3: 1, 20: 1, 4: 4, 5: 4, 7: 7, 8: 7, 9: 7, **{i: 100 for i in range(100, 161)}
    }
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


@pytest.mark.parametrize("block", [1024, 4])
def test_paragraphs_equal_all_pairs(spark, block):
    rng = random.Random(11)
    shared = [text(rng, 60) for _ in range(4)]
    rows = []
    for i in range(30):
        lines = [text(rng, rng.choice([3, 20, 40])) for _ in range(rng.choice([0, 1, 4]))]
        lines += [edited(rng, rng.choice(shared), rng.choice([0, 0, 1, 2])) for _ in range(rng.choice([0, 1, 2]))]
        rng.shuffle(lines)
        rows.append((i, "\n".join([*lines, "The end."])))
    rows += [(30, None), (31, ""), (32, shared[0]), (33, shared[0])]
    units = [(d, n, runs(tokens(line))) for d, t in rows for n, line in enumerate((t or "").split("\n")) if len(tokens(line)) >= 16]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(units)), 2) if jaccard(units[i][2], units[j][2]) >= 0.8]
    roots = groups(len(units), pairs)
    removed = {d: [] for d, _ in rows}
    for k, root in enumerate(roots):
        if root != k:
            removed[units[k][0]].append(units[k][1])
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)
    found = {r["doc_id"]: r for r in paragraphs.remove_repeated(docs, block=block).collect()}
    assert {d: r["removed"] for d, r in found.items()} == removed
    assert any(removed.values())
    for d, t in rows:
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in removed[d])
        assert found[d]["kept"] == kept
    repeated = {k for pair in pairs for k in pair}
    assert {d: r["n_repeated"] for d, r in found.items()} == {
        d: sum(units[k][0] == d for k in repeated) for d, _ in rows
    }
    assert paragraphs.remove_repeated(docs.limit(0)).collect() == []


def test_short_paragraphs_equal_all_pairs(spark):
    rng = random.Random(12)
    shared = [text(rng, n) for n in (5, 6, 9, 13, 15, 15)]
    rows = []
    for i in range(40):
        lines = [text(rng, rng.choice([2, 5, 8, 15, 25])) for _ in range(rng.choice([0, 1, 3]))]
        lines += [edited(rng, rng.choice(shared), rng.choice([0, 0, 0, 1])) for _ in range(rng.choice([1, 2]))]
        rows.append((i, "\n".join([*lines, "Read more of it here.", "The end."])))
    units = [(d, n, runs(tokens(line))) for d, t in rows for n, line in enumerate(t.split("\n")) if len(tokens(line)) >= 5]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(units)), 2) if jaccard(units[i][2], units[j][2]) >= 0.8]
    removed = {d: [] for d, _ in rows}
    for k, root in enumerate(groups(len(units), pairs)):
        if root != k:
            removed[units[k][0]].append(units[k][1])
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)
    found = {r["doc_id"]: r for r in paragraphs.remove_repeated(docs).collect()}
    assert {d: r["removed"] for d, r in found.items()} == removed
    repeated = {k for pair in pairs for k in pair}
    assert {d: r["n_repeated"] for d, r in found.items()} == {d: sum(units[k][0] == d for k in repeated) for d, _ in rows}
    assert len(repeated) > 80


def test_lines_under_five_words_can_be_compared_exactly(spark):
    rows = [(1, "The end.\nOne two three four five six\nA b"), (2, "the END\nother line here\na b c"), (3, "the end of\none two three four five six"), (4, "A, b!")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    usual = {r["doc_id"]: r["removed"] for r in paragraphs.remove_repeated(docs).collect()}
    assert usual == {1: [], 2: [], 3: [1], 4: []}
    short = {r["doc_id"]: r["removed"] for r in paragraphs.remove_repeated(docs, min_words=1).collect()}
    assert short == {1: [], 2: [0], 3: [1], 4: [0]}


def test_a_text_of_very_many_lines(spark):
    lines = [f"line number {i} of a very long text" for i in range(40_000)]
    again = [lines[i] if i % 2 else f"another line {i} that is not there" for i in range(40_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines), "x", 1), (2, "\n".join(again), "x", 1)], DOCS)
    found = {r["doc_id"]: r for r in paragraphs.remove_repeated(docs, similarity=0.99).collect()}
    assert found[1]["n_removed"] == 0 and found[2]["removed"] == list(range(1, 40_000, 2))
    assert found[2]["kept"] == "\n".join(again[::2])


def test_broadcasts_go_by_the_bytes_written(spark):
    from repotide.llm.common import hinted, stored

    wide = stored(spark.range(2000).select("id", F.sequence(F.col("id"), F.col("id") + 500).alias("s")), "wide")
    narrow = stored(spark.range(2000), "narrow")
    hint = lambda rows: "ResolvedHint" in rows._jdf.queryExecution().analyzed().toString()
    assert hint(hinted(narrow)) and hint(hinted(narrow.withColumnRenamed("id", "x")))
    assert not hint(hinted(wide, 10_000)) and hint(hinted(stored(narrow.where("id < 0"), "none"), 10_000))


def test_bands_are_tuned():
    hit = 0.8**paragraphs.BAND_ROWS
    assert 1 - (1 - hit) ** paragraphs.bands_for(0.8) >= paragraphs.RECALL
    assert 1 - (1 - hit) ** (paragraphs.bands_for(0.8) - 1) < paragraphs.RECALL
