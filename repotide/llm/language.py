"""Language ID by word-first backoff.

A word the model knows is scored by its log frequency in each language. An unseen word falls back to
its character n-grams, the longest of which any is known, down to single letters; the mean of their
log frequencies stands for the word. A text's language is the one with the largest sum, its score
the probability that the sums amount to.

The model is learned from a sample of at most ``TEXTS`` labelled texts per language, chosen by a hash
of the document number, and keeps the most frequent ``WORDS`` words and ``GRAMS`` n-grams of each
length per language. It is therefore bounded and goes to every task. All texts are scored whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import held_out, read, stored

TEXTS, WORDS, GRAMS = 4_000, 20_000, 6_000
LONGEST = 4
# Unseen words whose terms a task remembers.
REMEMBERED = 1 << 15
# Share of a count that every term is given in every language.
SMOOTHING = 0.5
UNKNOWN = "und"

# Characters that combine with the letter before them, by their Unicode category; they belong to its word.
IS_MARK = np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x1F000)])
MARKS = "".join(map(chr, np.flatnonzero(IS_MARK)))
WORD = re.compile(r"[^\W\d_]+")
# The same for texts with marks; slower, as there are thousands of them.
MARKED_WORD = re.compile(rf"(?:[^\W\d_]+|[{MARKS}]+)+")


class Model:
    """Log frequencies: ``terms`` names the row of a word ("w" first) or n-gram ("g" first)."""

    def __init__(self, languages: list[str], prior: np.ndarray, terms: dict[str, int], logs: np.ndarray):
        self.languages, self.prior, self.terms, self.logs = languages, prior, terms, logs

    def rows(self, word: str) -> list[int]:
        """The rows a word is scored by."""
        known = self.terms.get("w" + word)
        if known is not None:
            return [known]
        for n in range(LONGEST, 0, -1):
            text = f"^{word}$" if n > 1 else word
            found = [self.terms.get("g" + text[i : i + n]) for i in range(len(text) - n + 1)]
            found = [row for row in found if row is not None]
            if found:
                return found
        return []

    def predict(self, text: str | None, rows_of: Callable[[str], list[int]]) -> tuple[str, float]:
        """Language and score; ``rows_of`` is ``rows``, or that with a memory."""
        counts = Counter(words_of(text)) if text else {}
        if not self.languages or not any(c.isalpha() for word in counts for c in word):
            return UNKNOWN, 0.0
        rows: list[int] = []
        weights: list[float] = []
        get = self.terms.get
        for word, count in counts.items():
            known = get("w" + word)
            if known is not None:
                rows.append(known)
                weights.append(count)
            elif found := rows_of(word):
                rows += found
                weights += [count / len(found)] * len(found)
        sums = self.prior + np.asarray(weights) @ self.logs[rows] if rows else self.prior
        chances = np.exp(sums - sums.max())
        best = int(np.argmax(sums))
        return self.languages[best], float(chances[best] / chances.sum())


def has_marks(text: str) -> bool:
    if text.isascii():
        return False
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool(IS_MARK[np.minimum(codes, len(IS_MARK) - 1)].any())


def words_of(text: str) -> list[str]:
    """The words of a text, where it is learned from and where it is told."""
    lowered = text.lower()
    return (MARKED_WORD if has_marks(lowered) else WORD).findall(lowered)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): the words of the texts of a batch by language."""
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            counts.update((lang, word) for word in words_of(text.as_py()))
        if counts:
            langs, terms = zip(*counts)
            columns = {"lang": pa.array(langs), "term": pa.array(terms), "n": pa.array(list(counts.values()), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "term")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def _grams(text: Column, n: int) -> Callable[[Column], Column]:
    return lambda i: F.substring(text, i, F.lit(n))


def learn(labelled: DataFrame, texts: int = TEXTS, words: int = WORDS, grams: int = GRAMS) -> Model:
    """A model of rows (doc_id, text, lang). Rows with a null text or language teach nothing."""
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), {}, np.zeros((0, 0)))
    whole = 1 << 30
    share = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, int(whole * min(1.0, texts / n)))]
    )
    chance = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(whole))
    sample = rows.where(chance < F.element_at(share, F.col("lang")))
    counted = sample.select("lang", "text").mapInArrow(_counted, "lang STRING, term STRING, n BIGINT")
    counted = stored(counted.groupBy("lang", "term").agg(F.sum("n").alias("n")), "words")
    parts = []
    for n in range(1, LONGEST + 1):
        # The ends of a word are marked, but for single letters.
        text = F.concat(F.lit("^"), "term", F.lit("$")) if n > 1 else F.col("term")
        # A word shorter than n, ends included, has none.
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1))
        part = F.explode(F.transform(starts, _grams(text, n))).alias("term")
        parts.append(
            counted.select("lang", "n", part).groupBy("lang", "term").agg(F.sum("n").alias("n"))
            .withColumn("kind", F.lit(f"g{n}"))
        )
    kept = _most_frequent(counted.withColumn("kind", F.lit("w")), words)
    for part in parts:
        kept = kept.unionByName(_most_frequent(part, grams))
    table = kept.toPandas()
    names = (table["kind"].str[0] + table["term"]).to_numpy()
    terms = {name: i for i, name in enumerate(dict.fromkeys(names))}
    counts = np.zeros((len(terms), len(languages)))
    at = {lang: i for i, lang in enumerate(languages)}
    place = ([terms[n] for n in names], table["lang"].map(at).to_numpy(int))
    np.add.at(counts, place, table["n"].to_numpy(float))
    kinds = np.empty(len(terms), object)
    kinds[[terms[n] for n in names]] = table["kind"].to_numpy()
    logs = np.zeros_like(counts)
    for kind in set(kinds):
        own = kinds == kind
        part = counts[own] + SMOOTHING
        logs[own] = np.log(part / part.sum(axis=0))
    total = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, np.log(total / total.sum()), terms, logs)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` in place of any columns of these names.

    A null text, or one without a letter, is ``und`` with score 0, as is any text if nothing was
    learned. A very long text is counted word by word, whole, in memory of a few times its size. Letters of
    an unknown script go to the most frequent language, scored by its frequency.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("lang_pred", "score")
    memory: list[Callable[[str], list[int]]] = []

    def told(text: str | None) -> tuple[str, float]:
        if not memory:
            memory.append(lru_cache(REMEMBERED)(model.value.rows))
        return model.value.predict(text, memory[0])

    # Texts go to Python a hundred at a time, other columns not at all; Arrow's batches of 10,000 whole rows took
    # hundreds of MB of an executor outside its heap. Called not deterministic, so that no plan runs it twice for a row.
    found = F.udf(told, "lang_pred STRING, score DOUBLE", useArrow=False).asNondeterministic()
    rows = rest.withColumn("__told", found("text"))
    parts = {name: F.col("__told")[name] for name in ("lang_pred", "score")}
    return rows.withColumns(parts).drop("__told")


def language_id(docs: DataFrame, **limits: int) -> DataFrame:
    """Learn from four of five documents, by a hash of their number, and predict all.

    One row per document: doc_id, held_out, lang_pred, score. Only text and lang of the documents
    that are not held out are learned from; the prediction sees the text alone.
    """
    model = learn(docs.where(~held_out(F.col("doc_id"))), **limits)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, model).drop("text")


def op3_word_backoff_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))
