"""Passages of op2 against comparing all runs of words."""

import random

import numpy as np
import pyarrow as pa
import pytest

from repotide.llm import paragraphs, passages

DOCS = "doc_id BIGINT, text STRING"
WORDS = [f"{c}w{i}" for i, c in enumerate("aéIÑ" * 60)]


def text(rng, n):
    return "".join(w + rng.choice([" ", " ", ", ", ". ", "-"]) for w in rng.choices(WORDS, k=n)).strip(" ,.-")


def tokens(value):
    return "".join(c.lower() if c.isalnum() else " " for c in value or "").split()


def corpus():
    """Long lines and texts of short lines that share passages of about 50 words."""
    rng = random.Random(7)
    shared = [text(rng, n) for n in (49, 50, 51, 60, 75, 120, 130)]
    rows = []
    for i in range(60):
        parts = [text(rng, rng.choice([0, 1, 40, 150])) for _ in range(2)]
        middle = rng.choice([*shared, text(rng, 60)])
        if i % 7 == 3:
            middle = "\n".join(" ".join(middle.split()[j : j + 4]) for j in range(0, 200, 4))
        rows.append((i, f"{parts[0]} {middle} {parts[1]}\n{text(rng, rng.choice([2, 30]))}\nThe stock line ends it."))
    rows += [(70, rows[5][1]), (71, "tiny"), (72, "tiny"), (73, None), (74, ""), (None, rows[9][1]), (None, shared[5])]
    rows += [(75, f"... {shared[6]} {shared[6]} ?"), (76, f"{shared[4]}\n{text(rng, 20)}"), (77, shared[6])]
    return rows


def expected(rows, removed):
    """(passages, words, words cut, text kept) by row."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first = {}
    for k in order:
        if rows[k][1] is not None:
            first.setdefault(rows[k][1], k)
    holders, places = {}, {}
    for k, (_, t) in enumerate(rows):
        w = tokens(t)
        line_of = [n for n, line in enumerate((t or "").split("\n")) for _ in tokens(line)]
        places[k] = [(s, tuple(w[s : s + 50])) for s in range(len(w) - 49)]
        for s, run in places[k]:
            stays = not set(line_of[s : s + 50]) & set(removed[k])
            holders.setdefault(run, []).append((k, s, stays))
    out = []
    for k, (_, t) in enumerate(rows):
        held, cut = set(), set()
        for s, run in places[k]:
            if any(o != k for o, _, _ in holders[run]):
                held |= set(range(s, s + 50))
            stays = {first[rows[o][1]] for o, _, ok in holders[run] if ok and first[rows[o][1]] == o}
            if first[t] == k and k in stays and min(stays, key=order.index) != k:
                cut |= set(range(s, s + 50))
        kept = None if t is None else rejoined(t, cut, removed[k])
        out.append((sum(x - 1 not in held for x in held), len(held), len(cut), kept))
    return out


def rejoined(value, cut, removed):
    out, word, i = [], -1, 0
    while i < len(value):
        j, is_word = i, value[i].isalnum()
        while j < len(value) and value[j].isalnum() == is_word:
            j += 1
        word += is_word
        inside = word in cut if is_word else word in cut and word + 1 in cut
        out.append("".join(c for c in value[i:j] if c == "\n") if inside else value[i:j])
        i = j
    return "\n".join(x for n, x in enumerate("".join(out).split("\n")) if n not in removed)


def test_passages_equal_all_runs(spark):
    rows = corpus()
    found = paragraphs.remove_repeated(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    by_key = {(r["doc_id"], r["kept"] is None or r["n_bytes"]): r for r in found}
    found = [by_key[i, t is None or len(t.encode())] for i, t in rows]
    want = expected(rows, [r["removed"] for r in found])
    assert [(r["n_passages"], r["passage_words"], r["cut_words"], r["kept"]) for r in found] == want
    assert sum(w[2] > 0 for w in want) > 10 and sum(w[1] == 0 for w in want) > 5
    assert all(r["removed_bytes"] == r["n_bytes"] - len((r["kept"] or "").encode()) for r in found)


def test_a_passage_within_longer_lines_goes(spark):
    rng = random.Random(2)
    passage = text(rng, 60)
    rows = [(i, f"{text(rng, 100)} {passage} {text(rng, 90)}") for i in range(3)] + [(3, text(rng, 200))]
    rows = [(i, f"{t}\nA stock line that many have.") for i, t in rows]
    found = {r["doc_id"]: r for r in paragraphs.remove_repeated(spark.createDataFrame(rows, DOCS)).collect()}
    assert [found[i]["passage_words"] for i in range(4)] == [60, 60, 60, 0]
    assert [found[i]["cut_words"] for i in range(4)] == [0, 60, 60, 0]
    assert [passage in found[i]["kept"] for i in range(3)] == [True, False, False]


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_cores_are_counted_alike(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "ROWS", 5)
    texts = [(k, None if i is None else i, t) for k, (i, t) in enumerate(corpus()) if t]
    texts = spark.createDataFrame(texts, "text_id BIGINT, rep BIGINT, text STRING")
    removed = passages.stored(spark.createDataFrame([(3, [0]), (20, [0, 2])], "text_id BIGINT, removed ARRAY<INT>"), "r")
    usual, counted = (passages.repeated_passages(texts, removed, hot=h).collect() for h in (passages.HOT, hot))
    key = lambda rows: sorted(map(tuple, rows))
    assert key(usual) == key(counted) and any(r["cuts"] for r in usual)


def test_runs_of_long_texts_and_short_slices(monkeypatch):
    rng = np.random.default_rng(4)
    lists = [rng.integers(-(2**62), 2**62, n).tolist() for n in (0, 49, 50, 700, 3, 5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lists)], ["text_id", "hashes"])
    once = pa.Table.from_batches(passages._anchors([batch]))
    monkeypatch.setattr(passages, "STEP", 60)
    parts = pa.Table.from_batches(passages._anchors([batch]))
    assert sorted(once.to_pylist(), key=str) == sorted(parts.to_pylist(), key=str)
    assert set(once["text_id"].to_pylist()) == {2, 3, 5} and len(once) < (700 + 5000) / 15
