from __future__ import annotations

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from sievewell.llm import toxicity
from sievewell.llm.toxicity import COMPOSED, Grammar, OUTPUTS, PRIOR_WEIGHTS, grammar_parts

WORDS = {
    "idiot": {1}, "kill": {2}, "you": {3, 1}, "not": {4}, "said": {5, 1}, "never": {4}, "apple": {0}, "the": {0}, "moron": {1},
}


def in_turn(symbols):
    """Each symbol through the five transducers one after the other, not composed."""
    parts = grammar_parts()
    states, out = [0] * len(parts), np.zeros(len(OUTPUTS))
    for symbol in symbols:
        for i, part in enumerate(parts):
            out += part.puts[states[i], symbol]
            states[i], symbol = part.to[states[i], symbol], part.writes[states[i], symbol]
    return out


def test_the_composition_does_what_its_parts_do_in_turn():
    rng = random.Random(2)
    assert len(COMPOSED.to) == 2 * (toxicity.NEGATION_REACH + 1) * 3
    for _ in range(300):
        symbols = [rng.randrange(6) for _ in range(rng.randrange(12))]
        state, out = 0, np.zeros(len(OUTPUTS))
        for s in symbols:
            out += COMPOSED.puts[state, s]
            state = COMPOSED.to[state, s]
        assert (out == in_turn(symbols)).all()


def test_a_clause_is_scored_by_the_best_of_all_readings():
    learned = np.sort(toxicity._hash_of(["you", "said"]))
    grammar = Grammar(learned, PRIOR_WEIGHTS)
    rng = random.Random(3)
    texts = [[[rng.choice(list(WORDS)) for _ in range(rng.randrange(8))] for _ in range(rng.randrange(4))] for _ in range(200)]
    got = grammar.outputs([". ".join(" ".join(c) for c in t).encode() for t in texts]) @ PRIOR_WEIGHTS[:-1]
    for text, score in zip(texts, got):
        best = 0.0
        for clause in text:
            if any(WORDS[w] & {1, 2} for w in clause):
                best += max(in_turn(reading) @ PRIOR_WEIGHTS[:-1] for reading in itertools.product(*(sorted(WORDS[w]) for w in clause)))
        assert abs(best - score) < 1e-9


def test_long_clauses_and_many_of_them():
    grammar = Grammar(np.zeros(0, np.uint64), PRIOR_WEIGHTS)
    long = b"you " + b"apple " * 200_000 + b"idiot " * 5_000
    many = b"no idiot. " * 10_000
    out = grammar.outputs([long, many, b"", None])
    assert out[0].tolist() == [0, 5_000, 0, 0, 0, 0, 0, 0, 0]
    assert out[1].tolist() == [0, 0, 10_000, 0, 0, 0, 0, 0, 0]
    assert not out[2:].any()


def test_equal_texts_with_different_labels_both_teach(spark):
    rows = [(i, t, i % 2) for i in range(20) for t in ("one two three four", "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int").withColumn("text", F.coalesce("text", F.lit("")))
    kept = sorted(map(tuple, toxicity._unalike(frame.repartition(5)).collect()))
    assert kept == [(0, "", 0), (0, "one two three four", 0), (1, "", 1), (1, "one two three four", 1)]
