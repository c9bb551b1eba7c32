"""The filter audit against counting document by document."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from repotide.llm import audit

DOCS = "doc_id BIGINT, text STRING, lang STRING, failed STRING, part INT"
LABELS = "doc_id BIGINT, quality INT, toxic INT, good STRING"


def plain(docs, labels):
    """Rows by (part, filter_order, step), from the conditions as they are stated."""
    texts = [text or "" for _, text, _ in docs]
    judged = []
    for (doc_id, _, lang), text in zip(docs, texts):
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
        failed = set()
        if len(words) < 100:
            failed.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            failed.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            failed.add("C")
        if set(text) & set("#$%&*|"):
            failed.add("D")
        if doc_id is not None and any(t == text and i is not None and i < doc_id for (i, _, _), t in zip(docs, texts)):
            failed.add("E")
        of = [(q, t) for i, q, t in labels if i is not None and i == doc_id]
        judged.append((lang or "", failed, any(q == 1 for q, _ in of), any(t == 1 for _, t in of)))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in judged}:
        own = [j[1:] for j in judged if j[0] == part]
        for order in itertools.permutations("ABCDE"):
            for i, letter in enumerate(order):
                left = [j for j in own if not j[0] & set(order[:i])]
                gone = [j for j in left if letter in j[0]]
                out[part, "".join(order), i + 1] = [
                    len(left) - len(gone), len(gone), sum(letter in f for f, *_ in own) - len(gone),
                    sum(f == {letter} for f, *_ in own), sum(g for _, g, _ in gone), sum(t for _, _, t in gone)]
                shapley[part, letter] += len(gone)
    return {key: (*row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def found(spark, docs, labels):
    rows = audit.audit(
        spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*l, "x") for l in labels], LABELS),
    ).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def text_of(rng):
    n = rng.choice([0, 3, 99, 100, 101, 150])
    words = [rng.choice("abcdefgh") + str(rng.randrange(rng.choice([30, 900]))) for _ in range(n)]
    if rng.random() < 0.3:
        words = [w.upper() for w in words]
    if rng.random() < 0.3:
        words += [rng.choice(["#", "a|b", "50%", "é&", " x"])]
    return rng.choice([" ", "\n", "\t ", "\v\f"]).join(words)


def test_equals_counting(spark):
    rng = random.Random(3)
    pool = [text_of(rng) for _ in range(40)]
    docs = [(i, rng.choice(pool), rng.choice(["en", "de", None])) for i in range(160)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)]
    assert found(spark, docs, labels) == plain(docs, labels)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    docs = [(1, None, "en"), (2, "", "en"), (2, "", "en"), (None, "", "en"), (None, None, ""), (3, long, None), (4, long, None),
            (5, "a" * 3_000_000, "en"), (6, " ".join(["x"] * 200), "en"), (0, "é É Z", "fr")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (99, 1, 1), (4, 1, 1)]
    assert found(spark, docs, labels) == plain(docs, labels)


def test_no_rows(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [], [(1, 1, 1)]) == {}
    assert len(found(spark, [(1, "x", "en")], [])) == 600


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 100, 12_345])
def test_carry_save_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    want = [int(((words >> b) & 1).sum()) for b in range(32)]
    assert audit.positional_popcounts(words).tolist() == want


def test_truth_table():
    for failed in range(32):
        for subset in range(32):
            assert bool(int(audit.TRUTH[failed]) >> subset & 1) == (not failed & subset)


def test_pieces_end_between_words(monkeypatch):
    text = b"aa bb\tcc dddddddddd ee  ff"
    monkeypatch.setattr(audit, "CHUNK", 4)
    pieces = list(audit._chunks(text))
    assert b"".join(pieces) == text and len(pieces) > 3
    assert [w for p in pieces for w in p.split()] == text.split()
