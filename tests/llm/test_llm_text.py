"""Language, toxicity, licences and decontamination."""

import math
import random
import re
import textwrap
import unicodedata
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from repotide.llm import decontaminate, language, licences, toxicity
from repotide.llm.common import held_out

DOCS = "doc_id BIGINT, text STRING, lang STRING, score DOUBLE, lang_pred STRING"

STEMS = {"xx": ["ba", "bo", "bu", "bra"], "yy": ["ke", "ki", "kle", "ku"], "zz": ["mo", "mi", "mra", "mu"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(STEMS[lang], k=rng.randrange(1, 4))) for _ in range(n))


def languages(n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choices(list(STEMS), weights=[6, 2, 1])[0]
        out.append((i, sentence(rng, lang, rng.randrange(1, 30)), lang, 9.0, "no"))
    return out


def test_language_held_out(spark):
    rows = languages()
    extra = [(1000, None, "xx", 1.0, ""), (1001, "", "xx", 1.0, ""), (1002, "12 34 !?", "yy", 1.0, ""), (1003, "BAKU. boba!", None, 1.0, ""), (None, "keki kle", "yy", 1.0, ""), (1004, "数据", "xx", 1.0, "")]
    found = language.language_id(spark.createDataFrame(rows + extra, DOCS)).collect()
    assert len(found) == len(rows) + len(extra)
    told = {r["doc_id"]: r for r in found}
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 80 and all(r["lang_pred"] == truth[r["doc_id"]] for r in out)
    assert all(0 <= r["score"] <= 1 for r in found)
    for i in (1000, 1001, 1002):
        assert (told[i]["lang_pred"], told[i]["score"]) == ("und", 0.0)
    assert told[None]["lang_pred"] == "yy" and not told[None]["held_out"]
    assert told[1004]["lang_pred"] == "xx"


def test_language_without_teachers(spark):
    docs = spark.createDataFrame([(1, "some text", None, 0.0, "")], DOCS)
    row = language.language_id(docs).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert language.language_id(docs.limit(0)).collect() == []


def test_prediction_is_given_texts_alone_and_once(spark):
    rows = languages(60)
    docs = spark.createDataFrame(rows, DOCS)
    told = language.identify(docs, language.learn(docs))
    assert told.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    plan = plan_of(told.where("lang_pred != 'und' and score > 0.1").select("doc_id", "lang_pred"))
    # Batches of whole rows, texts included, once took an executor over its memory.
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan
    calls = [line for line in plan.splitlines() if "BatchEvalPython" in line]
    assert len(calls) == 1 and re.search(r"BatchEvalPython \[told\(text#\d+\)", calls[0])
    assert told.where("lang_pred = 'und'").count() == 0 and told.count() == len(rows)


def test_backoff_goes_from_long_to_short(spark):
    rows = [(i, "abcd abcd", "xx", 0.0, "") for i in range(30)] + [(100 + i, "wxyz wxyz", "yy", 0.0, "") for i in range(30)]
    model = language.learn(spark.createDataFrame(rows, DOCS))
    names = {row: name for name, row in model.terms.items()}
    assert [names[r] for r in model.rows("abcd")] == ["wabcd"]
    assert [names[r] for r in model.rows("abc")] == ["g^abc"]
    assert all(len(names[r]) == 3 for r in model.rows("qbcq"))
    assert [names[r] for r in model.rows("qaq")] == ["ga"]
    assert model.rows("数") == []


def plain_terms(texts):
    """Counts of words and n-grams by language, and texts by language, from words cut one character at a time."""
    def cut(text):
        out, word = [], ""
        for c in text.lower() + " ":
            if c.isalpha() or unicodedata.category(c)[0] in "MN" and unicodedata.category(c) not in ("Nd",) and (c.isalnum() or unicodedata.category(c)[0] == "M"):
                word += c
            else:
                out += [word] if word else []
                word = ""
        return out

    kinds, sizes = {}, Counter()
    for text, lang in texts:
        sizes[lang] += 1
        for word in cut(text):
            kinds.setdefault("w", Counter())[lang, word] += 1
            for n in range(1, 5):
                marked = f"^{word}$" if n > 1 else word
                for i in range(len(marked) - n + 1):
                    kinds.setdefault(f"g{n}", Counter())[lang, marked[i:i + n]] += 1
    return cut, kinds, sizes


def plain_language(text, cut, kinds, sizes):
    """The likeliest language and its probability, by adding logarithms term by term."""
    words = cut(text or "")
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    langs = sorted(sizes)
    known = {kind: {t for _, t in counts} for kind, counts in kinds.items()}
    total = {(kind, l): sum(n for (x, _), n in counts.items() if x == l) + 0.5 * len(known[kind]) for kind, counts in kinds.items() for l in langs}
    log = lambda kind, term, l: math.log((kinds[kind][l, term] + 0.5) / total[kind, l])
    sums = {l: math.log(sizes[l] / sum(sizes.values())) for l in langs}
    for word in words:
        terms = [("w", word)] if word in known["w"] else []
        for n in range(4, 0, -1):
            if not terms:
                marked = f"^{word}$" if n > 1 else word
                grams = [marked[i:i + n] for i in range(len(marked) - n + 1)]
                terms = [(f"g{n}", g) for g in grams if g in known[f"g{n}"]]
        for l in langs if terms else []:
            sums[l] += sum(log(kind, t, l) for kind, t in terms) / len(terms)
    best = max(langs, key=lambda l: sums[l])
    return best, 1 / sum(math.exp(sums[l] - sums[best]) for l in langs)


MARKED = ["हिन्दी भाषा में लिखा", "मैं किताब पढ़ता हूँ", "यह भाषा हिन्दी है"]
DECOMPOSED = [unicodedata.normalize("NFD", t) for t in ("l'été à la forêt", "où est le café", "très égaré")]


def test_language_equals_a_plain_backoff(spark):
    rng = random.Random(9)
    rows = [r for r in languages(200)] + [(1000 + i, rng.choice(MARKED), "hi", 0.0, "") for i in range(30)]
    rows += [(2000 + i, rng.choice(DECOMPOSED), "fr", 0.0, "") for i in range(30)]
    asked = [r[1] for r in rows] + ["bakle mozz", "été हिन्दी", "हिन", "x²y ½", "", None, "123 _ -", "q" * 50, "forêt foret", "भाषाएँ baba", "ba " * 30_000]
    model = language.learn(spark.createDataFrame(rows, DOCS))
    cut, kinds, sizes = plain_terms([(r[1], r[2]) for r in rows])
    assert {name[1:] for name in model.terms if name[0] == "w"} == {t for _, t in kinds["w"]}
    found = language.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id BIGINT, text STRING"), model)
    for row in found.collect():
        lang, score = plain_language(asked[row["doc_id"]], cut, kinds, sizes)
        assert row["score"] == pytest.approx(score, abs=1e-9), asked[row["doc_id"]][:40]
        assert row["lang_pred"] == lang


def test_marks_belong_to_their_word(spark):
    rows = [(i, t, "hi", 0.0, "") for i, t in enumerate(MARKED * 4)] + [(50 + i, t, "fr", 0.0, "") for i, t in enumerate(DECOMPOSED * 4)]
    model = language.learn(spark.createDataFrame(rows, DOCS))
    for text in MARKED + DECOMPOSED:
        for word in language.words_of(text):
            assert model.rows(word) == [model.terms["w" + word]]
    assert language.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert language.words_of(DECOMPOSED[0])[1] == unicodedata.normalize("NFD", "été")


def test_held_out_is_a_fifth(spark):
    share = spark.range(5000).agg(F.avg(held_out(F.col("id")).cast("int"))).first()[0]
    assert 0.17 < share < 0.23


def test_toxicity_held_out(spark):
    rng = random.Random(7)
    insults = ["grobl", "snurk", "flarn"]
    docs, labels = [], []
    for i in range(1500):
        text = sentence(rng, rng.choice(list(STEMS)), rng.randrange(5, 60)).split()
        toxic = i % 6 == 0
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(insults) + rng.choice(["", "en", "ish"]))
        docs.append((i, " ".join(text), None, 0.5, None))
        if i % 4:
            labels.append((i, int(toxic)))
    docs += [(9000, None, None, None, None), (9001, "", None, None, None), (None, "ba bo", None, None, None)]
    labels += [(9000, 1), (9001, None), (None, 1), (9002, 7)]
    table = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    found = toxicity.toxicity(spark.createDataFrame(docs, DOCS), table).collect()
    assert len(found) == len(docs)
    out = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 9000]
    right = [r["predicted"] == int(r["doc_id"] % 6 == 0) for r in out]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text", None, 0.0, None)], DOCS)
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    assert toxicity.toxicity(docs, none).first()["score"] == 0.5
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


def test_licences(spark):
    lines = ["Intro", "released UNDER the mit   licence", "", "Licensed under the Apache License, Version 2.0!", "Licensed under CC BY-NC 4.0", "License"]
    rows = [(1, "\n".join(lines), None, 0.0, None), (2, None, None, 0.0, None), (3, "", None, 0.0, None), (4, "x " * 5000, None, 0.0, None)]
    rows += [(5, "Released under the MIT License.\nReleased under the MIT License.", None, 0.0, None)] * 2
    found = licences.licences(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"], r["licence"], r["n_lines"], r["first_line"]) for r in found) == [
        (1, "Apache-2.0", 1, 3), (1, "CC-BY-NC-4.0", 1, 4), (5, "MIT", 4, 0)]
    assert licences.licences(spark.createDataFrame([], DOCS)).collect() == []


def test_dice_equals_counting(spark):
    rng = random.Random(3)
    template = "the quick brown fox and the quick red fox and the quick end of it all"
    rows, expected = [], {}
    for i in range(300):
        words = template.split()
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(["the", "quick", "new"])
        words = words[: rng.randrange(4, 20)] + ["tail"] * rng.randrange(0, 12)
        rows.append((i, " ".join(words), None, 0.0, None))
        a, b = ([*zip(w, w[1:])] for w in (words, template.split()))
        both = sum(min(a.count(g), b.count(g)) for g in set(a))
        if 2 * both / (len(a) + len(b)) >= 0.8:
            expected[i] = 2 * both / (len(a) + len(b))
    found = licences.licence_lines(spark.createDataFrame(rows, DOCS), (("T", template),))
    assert {r["doc_id"]: r["dice"] for r in found.collect()} == pytest.approx(expected)
    assert 30 < len(expected) < 300


@pytest.mark.parametrize("prefix", ["", "# ", " * "])
def test_licence_passages(spark, prefix):
    texts = [t for _, t in licences.TEMPLATES]
    long = {i for i, t in enumerate(texts) if len(t) > 100}
    wrapped = lambda t: ["Notes", *textwrap.wrap(t, 60), "and so on"]
    rows = [(i, "\n".join(prefix + line for line in wrapped(t)), None, 0.0, None) for i, t in enumerate(texts)]
    rows += [(100 + i, f"{prefix}It was written in a year. {t} Other words come after it here.", None, 0.0, None) for i, t in enumerate(texts)]
    rows.append((200, f"{texts[0]} {texts[5]} {texts[0]}", None, 0.0, None))
    rows.append((201, "one two three\nfour " + texts[3][:-60], None, 0.0, None))
    found = {}
    for r in licences.licences(spark.createDataFrame(rows, DOCS)).collect():
        found.setdefault(r["doc_id"], {})[r["licence"]] = (r["n_lines"], r["first_line"], r["dice"])
    for i, (licence, _) in enumerate(licences.TEMPLATES):
        assert list(found[i]) == list(found[100 + i]) == [licence]
        assert found[i][licence][:2] == (1, 1) and found[100 + i][licence][:2] == (1, 0)
    assert len(long) > 8 and {found[100 + i][texts_licence][2] for i, (texts_licence, _) in enumerate(licences.TEMPLATES) if i not in long} == {1.0}
    assert found[200] == {"MIT": (1, 0, 1.0), "Apache-2.0": (1, 0, 1.0)}
    assert found[201]["MIT"][:2] == (1, 1)


ITEMS = "item_id BIGINT, text STRING, runs STRING"


def leaks(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([12, 30, 55])))) for k in range(12)]
    items += [(20, "a b a b a b a b a b a b a b a b"), (21, "too short now"), (22, None), (23, "")]
    docs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if i % 2:
            passage = rng.choice(items[:13])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = "zz"
            cut = rng.choice([0, 0, 1, 5])
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[cut:]
        docs.append((i, ", ".join(words)))
    return docs + [(200, None), (201, ""), (202, items[0][1])] + [(203, items[1][1])] * 2, items


def brute_leaks(docs, items):
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for d, t in docs:
        words = (t or "").replace(",", "").split()
        for k, item in items:
            wanted = grams((item or "").split())
            if not wanted or len(words) < 5:
                continue
            runs, n = grams(words), len(wanted)
            for start in range(max(1, len(runs) - n + 1)):
                window = runs[start : start + n]
                both = sum(min(window.count(g), wanted.count(g)) for g in set(window))
                alike = both / (len(window) + len(wanted) - both)
                if alike >= 0.8:
                    out[d, k] = max(alike, out.get((d, k), 0))
    return out


def test_contaminated_equals_every_window(spark):
    docs, items = leaks()
    table = spark.createDataFrame([(d, t, None, 0.0, None) for d, t in docs], DOCS).repartition(3)
    benchmark = spark.createDataFrame([(k, t, "") for k, t in items], ITEMS)
    expected = brute_leaks(docs, items)
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(table, benchmark).collect()}
    assert found == pytest.approx(expected)
    assert len(expected) > 25
    kept = decontaminate.clean(table, benchmark)
    dirty = {d for d, _ in expected}
    assert sorted(r["doc_id"] for r in kept.collect()) == [d for d, _ in docs if d not in dirty]
    assert decontaminate.contaminated(table.limit(0), benchmark).collect() == []
    assert decontaminate.contaminated(table, benchmark.limit(0)).collect() == []


def test_index_finds_all_within_the_radius():
    """Fifteen differing bits over four blocks leave a block with at most three."""
    rng = random.Random(1)
    for _ in range(2000):
        bits = rng.sample(range(64), decontaminate.RADIUS)
        counts = [sum(b // decontaminate.BLOCK_BITS == i for b in bits) for i in range(decontaminate.BLOCKS)]
        assert min(counts) <= decontaminate.VARIANT_BITS
