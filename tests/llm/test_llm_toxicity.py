"""The grammar of toxicity: its transducers, against a plain reading, and what each adds."""

import random

import pytest

from repotide.llm import toxicity
from repotide.llm.toxicity import AIMED, CASCADE, INSULT, MENACE, NEGATED, PRIORS, REPORTED, THREAT

DOCS = "doc_id BIGINT, text STRING, score DOUBLE"


def test_contexts_of_a_clause():
    grammar = toxicity.Grammar({"idiot$": 4.0, "vile": 2.0})
    found = lambda text: [context for _, context in grammar.matches(text.split())]
    assert found("an idiot") == found("a vilest thing") == [INSULT]
    assert found("you idiot") == found("idiot you are") == [INSULT | AIMED]
    assert found("not an idiot") == [INSULT | NEGATED]
    assert found("never once seen the idiot") == [INSULT]
    assert found("she said idiot") == [INSULT | AIMED | REPORTED] and found("sam said idiot") == [INSULT | REPORTED]
    assert found("idiot said sam") == [INSULT]
    assert found("i will hurt you") == [MENACE] and found("sam said i will hurt you") == [MENACE | REPORTED]
    for text in ("i will not hurt you", "hurt you", "you will", "hurt you will", "idiots", ""):
        assert found(text) == []
    assert found("i will hurt you idiot") == [MENACE, INSULT | AIMED]
    assert grammar.insult("vilely") == "vile"


def test_weights_follow_the_context():
    grammar = toxicity.Grammar({"idiot$": 4.0})
    weigh = lambda text: grammar.clause(text.split())
    assert weigh("an idiot") == 4.0 * PRIORS[INSULT] < weigh("you idiot")
    assert weigh("you are not an idiot") < weigh("you idiot") and weigh("sam said idiot") < weigh("you idiot")
    assert weigh("i will hurt you") == THREAT * PRIORS[MENACE]
    assert weigh("nothing of the kind") == 0
    # Contexts end with the clause.
    assert grammar.contexts("Not so. An idiot!") == [INSULT]
    assert grammar.contexts("He said so; you idiot") == [INSULT | AIMED]


def plain(words, insults):
    """The contexts of a clause, word by word and without machines."""
    kinds = [toxicity.LABELS.get(w, INSULT if w in insults else toxicity.OTHER) for w in words]
    # A word is negated if one of the three words before it is a negation.
    negated = [toxicity.NEGATION in kinds[max(0, i - toxicity.REACH):i] for i in range(len(kinds))]
    reported = [toxicity.REPORT in kinds[:i] for i in range(len(kinds))]
    out, mood = [], 0
    for i, kind in enumerate(kinds):
        if kind == INSULT:
            out.append(INSULT | (NEGATED if negated[i] else 0) | (REPORTED if reported[i] else 0) | (AIMED if toxicity.TARGET in kinds else 0))
        elif kind == toxicity.INTENT and not negated[i]:
            mood = 1
        elif kind == toxicity.HARM and mood and not negated[i]:
            mood = 2
        elif kind == toxicity.TARGET and mood == 2:
            out.append(MENACE | (REPORTED if reported[i] else 0))
            mood = 0
    return out


@pytest.mark.parametrize("seed", range(4))
def test_the_composed_machine_equals_a_plain_reading(seed):
    rng = random.Random(seed)
    words = ["grob", "snurk", "you", "not", "said", "will", "hurt", "a", "b", "c"]
    grammar = toxicity.Grammar({"grob$": 3.0, "snurk$": 2.0})
    for _ in range(2000):
        clause = rng.choices(words, weights=[2, 2, 2, 1, 1, 2, 2, 3, 3, 3], k=rng.randrange(0, 12))
        assert [c for _, c in grammar.matches(clause)] == plain(clause, {"grob", "snurk"}), clause


def test_machines_compose_in_order():
    machine = toxicity.composed(CASCADE)
    state, out = machine.start, []
    for label in (toxicity.REPORT, toxicity.NEGATION, toxicity.INSULT, toxicity.TARGET, toxicity.END):
        state, symbol = machine.step(state, label)
        out.append(symbol)
    assert out[2] == INSULT | NEGATED | REPORTED and out[-1] == toxicity.END | AIMED
    # Without the first one the same insult is only reported.
    rest = toxicity.composed(CASCADE[1:])
    state = rest.start
    for label in (toxicity.REPORT, toxicity.NEGATION, toxicity.INSULT):
        state, symbol = rest.step(state, label)
    assert symbol == INSULT | REPORTED


FILLER = ["bana", "keri", "molo", "tuki", "sanu", "pelo"]
CLAUSES = {
    "aimed": (["you {x}"], 1),
    "bare": (["a {x}"], 0),
    "negated": (["you are not a {x}"], 0),
    "reported": (["sam said you {x}"], 0),
    "threat": (["i will hurt you"], 1),
    "harmless": (["i will not hurt you"], 0),
    "clean": (["{f}"], 0),
}


def in_context(seed=5, n=3000):
    rng = random.Random(seed)
    filler = lambda: " ".join(rng.choices(FILLER, k=rng.randrange(3, 6)))
    docs, labels, kinds = [], [], {}
    for i in range(n):
        kind = rng.choices(list(CLAUSES), weights=[6, 0.7, 0.7, 0.7, 2, 1, 18])[0]
        (clause,), toxic = CLAUSES[kind]
        clause = clause.format(x=rng.choice(["grobl", "snurk"]), f=filler())
        docs.append((i, f"{filler()}. {clause}. {filler()}.", 0.0))
        labels.append((i, toxic))
        kinds[i] = kind
    return docs, labels, kinds


def right_by_kind(spark, machines):
    docs, labels, kinds = in_context()
    found = toxicity.toxicity(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT"), machines=machines
    )
    right: dict[str, list] = {}
    for row in found.where("held_out").collect():
        right.setdefault(kinds[row["doc_id"]], []).append(row["predicted"] == CLAUSES[kinds[row["doc_id"]]][1])
    return {kind: sum(own) / len(own) for kind, own in right.items()}


def test_each_transducer_flips_decisions(spark):
    negation, report, threat, target = CASCADE
    whole = right_by_kind(spark, CASCADE)
    assert min(whole.values()) == 1.0, whole
    lost = {
        "negated": (report, threat, target),
        "reported": (negation, threat, target),
        "threat": (negation, report, target),
    }
    for kind, machines in lost.items():
        assert right_by_kind(spark, machines)[kind] < 0.6, kind
    # Without the target an insult aimed at somebody is one like any other.
    without = right_by_kind(spark, (negation, report, threat))
    assert min(without["aimed"], without["bare"]) < 0.6


def test_a_beginning_needs_several_words(spark):
    rows = [("grobl here", 1)] * 9 + [("snurka x", 1), ("snurko x", 1), ("snurki x", 1), ("snurke x", 1)] + [("fine words", 0)] * 30
    kept = toxicity.insult_weights(spark.createDataFrame(rows, "text STRING, toxic INT"))
    assert "grobl$" in kept and not any(p.startswith("gro") for p in kept if p != "grobl$")
    assert "snu" in kept and "snurka$" not in kept


def test_a_very_long_text_is_read_whole(spark):
    text = "bana keri. " * 200_000 + "you grobl."
    grammar = toxicity.Grammar({"grobl$": 5.0})
    assert grammar.contexts(text) == [INSULT | AIMED]
    rows = spark.createDataFrame([(text, 1), (None, 0), ("", 0)], "text STRING, toxic INT")
    found = [r["features"] for r in toxicity._featured(rows, grammar).collect()]
    assert found[0][0] == 5.0 * PRIORS[INSULT | AIMED] and found[1] == found[2] == [0.0] * 5
