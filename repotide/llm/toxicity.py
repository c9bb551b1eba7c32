"""Toxicity by a weighted finite-state grammar over clauses.

Each word of a clause gets a label: insult (a learned word, or a learned beginning that several words
share), target, negation, report, intent, harm or other. The labels pass a cascade of transducers, each of which
rewrites what the one before it puts out: negation marks what it reaches, reported speech what follows it,
threat turns intent, harm and a target in this order into a threat, and target marks the end of the
clause if there was one. ``composed`` makes one machine of them, whose transitions are kept in a table.

What comes out are insults and threats with their context, and a clause weighs the sum of theirs. An insult weighs
its own log odds times the factor of its context: whether it is aimed, negated, reported, or none of it,
an isolated word. Each factor starts from a prior, low for isolated words, and moves to what labelled texts with
insults in that context show. A clause without such a match weighs nothing.

Learning uses at most ``TEXTS`` labelled texts, chosen by a hash of their number. Insults are words
and beginnings with the log odds of a toxic text as weights. Factors, and a logistic curve that leads from what
the clauses of a text weigh to its probability, are fitted on each half of the texts read by the insults of
the other half, so that they see no text their insults come from. All texts are scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StructField, StructType

from repotide.llm.common import held_out, read, stored

TEXTS = 16_000
# Shortest and longest word beginning that can be an insult, how many toxic texts must hold an insult, and how many
# words must share a beginning.
SHORTEST, LONGEST, TIMES, FORMS = 3, 10, 4, 3
LEAST_WEIGHT = 1.5

CLAUSES = re.compile(r"[.!?;:|\n]+")
WORDS = re.compile(r"[^\W_]+")

TARGETS = frozenset(
    "you your yours u ur they them their he him his she her people "
    "du dich ihr sie tu toi vous ellos usted".split()
)
NEGATIONS = frozenset(
    "not no never none isn aren wasn don doesn cannot without "
    "nicht kein keine nie ne pas jamais nunca sin".split()
)
REPORTS = frozenset(
    "said says say told tells wrote writes called calls quoted quotes reported claimed "
    "sagte schrieb dit dijo".split()
)
INTENTS = frozenset("will ll gonna shall going want must".split())
HARMS = frozenset("kill hurt beat destroy punch stab shoot burn attack smash".split())

# Words that a negation reaches.
REACH = 3
# What a threat weighs before its factor.
THREAT = 4.0

# Labels of words, and the end of a clause.
OTHER, INSULT, TARGET, NEGATION, REPORT, INTENT, HARM, MENACE, END = range(9)
# Marks that transducers put on a label.
NEGATED, REPORTED, AIMED = 16, 32, 64
KIND = 15

LABELS = {
    **{word: TARGET for word in TARGETS},
    **{word: NEGATION for word in NEGATIONS},
    **{word: REPORT for word in REPORTS},
    **{word: INTENT for word in INTENTS},
    **{word: HARM for word in HARMS},
}

# Factors by context before anything is learned, and how many texts they count for.
PRIORS = {
    INSULT: 0.25,
    INSULT | AIMED: 1.25,
    INSULT | NEGATED: 0.1,
    INSULT | REPORTED: 0.25,
    INSULT | AIMED | NEGATED: 0.25,
    INSULT | AIMED | REPORTED: 0.5,
    INSULT | NEGATED | REPORTED: 0.1,
    INSULT | AIMED | NEGATED | REPORTED: 0.1,
    MENACE: 1.0,
    MENACE | REPORTED: 0.4,
}
PRIOR_TEXTS = 10
MOST_FACTOR = 2.0

State = object
Step = Callable[[State, int], tuple[State, int]]


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: from a state and an input symbol to the next state and an output symbol."""

    start: State
    step: Step


def _negation(left: int, symbol: int) -> tuple[int, int]:
    kind = symbol & KIND
    if kind == NEGATION:
        return REACH, symbol
    if not left:
        return 0, symbol
    # Negated intent or harm threatens nobody.
    out = OTHER if kind in (INTENT, HARM) else symbol | NEGATED if kind == INSULT else symbol
    return left - 1, out


def _report(reported: bool, symbol: int) -> tuple[bool, int]:
    kind = symbol & KIND
    if reported and kind in (INSULT, TARGET, HARM):
        return True, symbol | REPORTED
    return reported or kind == REPORT, symbol


def _threat(state: int, symbol: int) -> tuple[int, int]:
    """States: nothing, intent, harm meant."""
    kind = symbol & KIND
    if kind == INTENT:
        return 1, symbol
    if kind == HARM and state:
        return 2, symbol
    if kind == TARGET and state == 2:
        return 0, MENACE | (symbol & REPORTED) | AIMED
    return state, symbol


def _target(aimed: bool, symbol: int) -> tuple[bool, int]:
    if symbol & KIND == END:
        return False, END | (AIMED if aimed else 0)
    return aimed or symbol & KIND in (TARGET, MENACE), symbol


CASCADE = (Transducer(0, _negation), Transducer(False, _report), Transducer(0, _threat), Transducer(False, _target))


def composed(machines: Sequence[Transducer]) -> Transducer:
    """One machine that passes each symbol through all, its transitions worked out once each."""
    table: dict[tuple[State, int], tuple[State, int]] = {}

    def step(states: State, symbol: int) -> tuple[State, int]:
        known = table.get((states, symbol))
        if known is None:
            after, out = [], symbol
            for machine, state in zip(machines, states):
                state, out = machine.step(state, out)
                after.append(state)
            known = table[states, symbol] = tuple(after), out
        return known

    return Transducer(tuple(machine.start for machine in machines), step)


class Grammar:
    """``weights``: insults, a word ended by "$" or a word's beginning, and their weights."""

    def __init__(self, weights: dict[str, float], factors: dict[int, float] = PRIORS, machines=CASCADE) -> None:
        self.weights, self.factors, self.machines = weights, dict(factors), machines
        self.starts = frozenset(pattern[:SHORTEST] for pattern in weights)
        self.machine = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "machine": None}

    def insult(self, word: str) -> str:
        """The longest insult that a word matches, if any."""
        if word[:SHORTEST] in self.starts:
            if word + "$" in self.weights:
                return word + "$"
            for n in range(min(LONGEST, len(word)), SHORTEST - 1, -1):
                if word[:n] in self.weights:
                    return word[:n]
        return ""

    def matches(self, words: list[str]) -> list[tuple[str, int]]:
        """Insults (threats: no text) of a clause with their contexts."""
        if self.machine is None:
            self.machine = composed(self.machines)
        state, step, found = self.machine.start, self.machine.step, []
        for word in words:
            pattern = ""
            label = LABELS.get(word, OTHER)
            if label == OTHER:
                pattern = self.insult(word)
                label = INSULT if pattern else OTHER
            state, out = step(state, label)
            if out & KIND in (INSULT, MENACE):
                found.append((pattern, out))
        _, end = step(state, END)
        return [(p, out | (end & AIMED) if out & KIND == INSULT else out & ~AIMED) for p, out in found]

    def weight(self, pattern: str, context: int) -> float:
        return (self.weights[pattern] if pattern else THREAT) * self.factors[context]

    def clause(self, words: list[str]) -> float:
        """The weight of a clause; 0 without a match."""
        return sum(self.weight(*match) for match in self.matches(words))

    def read(self, text: str | None) -> tuple[list[list[tuple[str, int]]], int]:
        """The matches of each clause that has any, and the number of words of a text."""
        lowered = text.lower() if text else ""
        words = WORDS.findall(lowered)
        starts = {word[:SHORTEST] for word in set(words)}
        if not starts & self.starts and not starts & HARM_STARTS:
            return [], len(words)
        clauses = (self.matches(WORDS.findall(clause)) for clause in CLAUSES.split(lowered))
        return [found for found in clauses if found], len(words)

    def contexts(self, text: str | None) -> list[int]:
        """The contexts in which a text has insults or threats."""
        clauses, _ = self.read(text)
        return sorted({context for found in clauses for _, context in found})

    def features(self, text: str | None) -> list[float]:
        """Sums over the clauses of a text that match; zeros for a text without a match."""
        clauses, n_words = self.read(text)
        scores = [sum(self.weight(*match) for match in found) for found in clauses]
        kinds: dict[str, float] = {}
        for found in clauses:
            for match in found:
                kinds[match[0]] = max(kinds.get(match[0], 0.0), self.weight(*match))
        total = sum(scores)
        rate = total / math.sqrt(n_words) if n_words else 0.0
        return [max(scores, default=0.0), math.log1p(total), rate, math.log1p(sum(kinds.values())), math.log1p(n_words)]


HARM_STARTS = frozenset(word[:SHORTEST] for word in HARMS)


def _patterns(text: str, wanted: frozenset | None = None) -> set[str]:
    out = set()
    for word in set(WORDS.findall(text.lower())):
        out.add(word + "$")
        out.update(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return out if wanted is None else out & wanted


def _counted(rows: DataFrame, wanted: frozenset | None) -> DataFrame:
    """In how many of the texts each pattern occurs; added up within a task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(_patterns(text, wanted))
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"]
            )

    counted = rows.select("text").mapInArrow(run, "pattern STRING, n BIGINT")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"))


def insult_weights(rows: DataFrame) -> dict[str, float]:
    """Insults and their log odds, from a bounded number of rows (text, toxic).

    A beginning is kept only if several words of toxic texts share it, and a longer one only if it says
    more than those it extends.
    """
    n1, n0 = _sizes(rows)
    found = _counted(rows.where("toxic = 1"), None)
    word = F.expr("substring(pattern, 1, length(pattern) - 1)")
    beginning = F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.length(word), F.lit(LONGEST))), lambda k: F.substring(word, F.lit(1), k)
    )
    forms = found.where(F.col("pattern").endswith("$") & (F.length(word) >= SHORTEST))
    forms = forms.select(F.explode(beginning).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("forms"))
    often = found.where(F.col("n") >= TIMES).join(forms, "pattern", "left")
    often = often.where(F.col("pattern").endswith("$") | (F.col("forms") >= FORMS))
    toxic = {r["pattern"]: r["n"] for r in often.collect()}
    clean = _counted(rows.where("toxic = 0"), frozenset(toxic))
    clean = {r["pattern"]: r["n"] for r in clean.collect()}
    odds = {p: _log_odds(n, clean.get(p, 0), n1, n0) for p, n in toxic.items()}
    kept: dict[str, float] = {}
    for pattern in sorted(odds, key=lambda p: (len(p), p)):
        stem = pattern.removesuffix("$")
        shorter = max((kept.get(stem[:k], 0.0) for k in range(SHORTEST, len(pattern))), default=0.0)
        if stem not in LABELS and odds[pattern] >= max(LEAST_WEIGHT, shorter + 0.5):
            kept[pattern] = odds[pattern]
    return kept


def _sizes(rows: DataFrame) -> tuple[int, int]:
    """Texts that are toxic, and texts that are not."""
    n = dict(rows.groupBy("toxic").agg(F.count("*")).collect())
    return n.get(1, 0), n.get(0, 0)


def _log_odds(toxic: int, clean: int, n1: int, n0: int) -> float:
    return math.log((toxic + 0.5) / (n1 + 1)) - math.log((clean + 0.5) / (n0 + 1))


def context_factors(read: DataFrame, n1: int, n0: int) -> dict[int, float]:
    """Factors of contexts from labelled texts (toxic, contexts).

    What texts with an insult in a context show, as a part of what those with any insult do, counts
    for as many texts as there are of them; the prior for ``PRIOR_TEXTS``.
    """
    by_kind = F.explode(F.array_distinct(F.concat("contexts", F.array(F.lit(-1)))))
    seen = read.where(F.size("contexts") > 0).select("toxic", by_kind.alias("context"))
    counts: dict[int, dict[int, int]] = {}
    for row in seen.groupBy("context", "toxic").agg(F.count("*").alias("n")).collect():
        counts.setdefault(row["context"], {})[row["toxic"]] = row["n"]
    usual = counts.get(-1, {})
    most = _log_odds(usual.get(1, 0), usual.get(0, 0), n1, n0) if usual else 0.0
    factors = {}
    for context, prior in PRIORS.items():
        own = counts.get(context, {})
        n = sum(own.values()) if most > 0 else 0
        shown = max(0.0, _log_odds(own.get(1, 0), own.get(0, 0), n1, n0) / most) if n else 0.0
        factors[context] = min(MOST_FACTOR, (n * shown + PRIOR_TEXTS * prior) / (n + PRIOR_TEXTS))
    return factors


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve, the constant last, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = ridge * np.r_[w[:-1], 0]
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, texts: int = TEXTS, machines=CASCADE) -> tuple[Grammar, np.ndarray]:
    """Grammar and curve from the labelled documents that are not held out.

    ``machines`` may leave transducers out, to see what they add.

    Labels that are null or neither 0 nor 1 teach nothing, nor do null texts.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").alias("of"), "toxic")
    n = known.count()
    whole = 1 << 30
    chance = F.pmod(F.xxhash64(F.lit("sample"), "of"), F.lit(whole))
    # Bounded by ``texts``, but for the chance of the hash.
    sample = known.where(chance < F.lit(int(whole * min(1.0, texts / max(1, n)))))
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("of")).where("text is not null")
    half = F.pmod(F.xxhash64(F.lit("half"), "of"), F.lit(2)).alias("half")
    rows = stored(rows.select("text", "toxic", half), "labelled")
    halves = [rows.where(F.col("half") == i).select("text", "toxic") for i in (0, 1)]
    others = [insult_weights(half) for half in halves[::-1]]

    def both(read: Callable[[DataFrame, Grammar], DataFrame], factors: dict[int, float]) -> DataFrame:
        one, two = (read(half, Grammar(weights, factors, machines)) for half, weights in zip(halves, others))
        return one.unionByName(two)

    factors = context_factors(stored(both(_in_context, PRIORS), "contexts"), *_sizes(rows))
    fitted = both(_featured, factors).toPandas()
    grammar = Grammar(insult_weights(rows), factors, machines)
    if fitted["toxic"].nunique() < 2:
        return grammar, np.zeros(6)
    curve = logistic(np.array(fitted["features"].tolist()), fitted["toxic"].to_numpy(float))
    return grammar, curve


def _read(rows: DataFrame, grammar: Grammar, name: str, kind: pa.DataType, sql: DataType) -> DataFrame:
    """What a method of the grammar makes of the text, in place of it."""
    grammar = rows.sparkSession.sparkContext.broadcast(grammar)
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method = getattr(grammar.value, name)
        for batch in batches:
            found = [method(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(found, pa.list_(kind))], [*rest, name]
            )

    fields = [*rows.drop("text").schema.fields, StructField(name, ArrayType(sql))]
    return rows.mapInArrow(run, StructType(fields))


def _featured(rows: DataFrame, grammar: Grammar) -> DataFrame:
    return _read(rows, grammar, "features", pa.float64(), DoubleType())


def _in_context(rows: DataFrame, grammar: Grammar) -> DataFrame:
    return _read(rows, grammar, "contexts", pa.int32(), IntegerType())


def toxicity(docs: DataFrame, labels: DataFrame, texts: int = TEXTS, machines=CASCADE) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted.

    A null or empty text has no match and scores by its length, 0, alone. A very long text is read
    whole, one at a time, in memory of a few times its size. Without labels of both
    kinds every score is 0.5. Repeated rows score alike; other columns of the input are ignored.
    """
    grammar, curve = learn(docs, labels, texts, machines)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    features = F.col("features")
    logit = sum((features[i] * float(w) for i, w in enumerate(curve[:-1])), F.lit(float(curve[-1])))
    score = 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))
    scored = _featured(rows, grammar).withColumn("score", score)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)


def op7_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
