from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import product
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievewell.llm import markov
from sievewell.llm.markov import Expected, Model, Shape, Steps, expect, fit, gather, improved, log10_probabilities, score_texts, symbol_of, to_blocks, usage, vocabulary

SMALL = Shape(states=3, symbols=64, rounds=2, early_rounds=2, prior=5.0)


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)] + [markov.END]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def plain_forward(symbols, model):
    a = model.first * model.give[:, symbols[0]]
    for s in symbols[1:]:
        a = (a @ model.move) * model.give[:, s]
    return a.sum()


def plain_counts(sequences, model):
    """Expected counts by going through every sequence of states."""
    states, symbols = model.give.shape
    out = Expected.none(symbols, states)
    for seq in sequences:
        paths = {}
        for path in product(range(states), repeat=len(seq)):
            p = model.first[path[0]] * model.give[path[0], seq[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.give[path[t], seq[t]]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            out.first[path[0]] += p / total
            for t, s in enumerate(path):
                out.give[s, seq[t]] += p / total
                if t:
                    out.move[path[t - 1], s] += p / total
    return out


@pytest.fixture
def model():
    rng = np.random.default_rng(5)
    deal = lambda *shape: (x := rng.random(shape) + 0.05) / x.sum(axis=-1, keepdims=True)
    return Model(deal(3), deal(3, 3), deal(3, 6))


SEQUENCES = [[0], [1, 2], [3, 4, 5, 0], [2] * 7, [5, 1, 0, 2, 4, 3], [0], [1, 1, 1]]


@pytest.mark.parametrize("span", [1, 4, 9, 1 << 19])
def test_recursions_equal_to_summing_over_all_state_sequences(model, monkeypatch, span):
    monkeypatch.setattr(markov, "SPAN", span)
    steps = Steps.of(np.array(sum(SEQUENCES, [])), np.array([len(s) for s in SEQUENCES]))
    assert np.allclose(log10_probabilities(steps, model), [log10(plain_forward(s, model)) for s in SEQUENCES], rtol=1e-12)
    got, want = expect(steps, model), plain_counts(SEQUENCES, model)
    assert np.allclose(got.first, want.first) and np.allclose(got.move, want.move) and np.allclose(got.give, want.give)


def test_texts_of_like_length_together_count_as_each_by_itself_in_few_steps(model):
    rng = np.random.default_rng(3)
    lengths = np.where(np.arange(400) % 100 == 0, 900, rng.integers(1, 30, 400))
    symbols, starts = rng.integers(0, 6, lengths.sum()), np.cumsum(lengths) - lengths
    groups = list(markov.alike(lengths, 4000))
    assert sorted(np.concatenate(groups)) == list(range(400)) and all(lengths[g].sum() <= 4000 for g in groups)
    assert [g.tolist() for g in markov.alike(np.array([3, 9, 3]), 6)] == [[1], [0, 2]] and list(markov.alike(lengths[:0], 6)) == []
    got, want, took, room = Expected.none(6, 3), Expected.none(6, 3), 0, markov.Room()
    for g in groups:
        steps = Steps.of(symbols, lengths[g], starts[g])
        expect(steps, model, got, room)
        took += len(steps.live)
    for at, n in zip(starts, lengths):
        expect(Steps.of(symbols[at : at + n], np.array([n])), model, want)
    assert np.allclose(got.first, want.first) and np.allclose(got.move, want.move) and np.allclose(got.give, want.give)
    # Four blocks of a hundred texts, each with a long one, took 900 steps each.
    assert took < 1000


def test_crc_of_many_words_is_that_of_each():
    rng = np.random.default_rng(2)
    n = markov.LONG_WORD
    some = [rng.bytes(k) for k in (*rng.integers(0, 12, 300).tolist(), n - 1, n, n + 1, 500, 0)]
    for words in (some, [], [b""], [b"", b"x"], [b"a" * n], [b"a" * (n - 1)], ["é😀".encode()]):
        got = pa.array(words, pa.binary())
        assert markov.crc32(got).tolist() == [zlib.crc32(w) for w in words]
        assert markov.crc32(got[1:]).tolist() == [zlib.crc32(w) for w in words[1:]]


def test_a_word_has_one_row_for_many_texts_of_a_task(spark, tmp_path):
    """Nine MB of text had a row for each word and three MB, which the window over words then had to sort."""
    text = "array_join(transform(sequence(1, 1000), i -> 'word' || (i * 7 + id) % 2000), ' ')"
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", f"{text} AS text")
    to_blocks(rows, F.lit(False), SMALL, "doc_id", "text").write.parquet(str(tmp_path / "blocks"))
    found = vocabulary(spark.read.parquet(str(tmp_path / "blocks")), SMALL.symbols)
    assert found.count() == found.where("leads").count() == 2001
    assert found.agg(F.sum("c")).first()[0] == 1000 * 1001


def test_single_precision_holds_where_states_hardly_ever_change():
    """Texts that jump at every step between two states that move once in 300,000,000 symbols."""
    rare = 3e-9
    double = Model(np.array([1 - rare, rare]), np.array([[1 - rare, rare], [rare, 1 - rare]]), np.array([[1, 1e-12, 0.5], [1e-12, 1, 0.5]]))
    single = Model(*(x.astype(np.float32) for x in (double.first, double.move, double.give)))
    sequences = [[1, 0] * 200, [0, 1, 1, 0, 2] * 50, [1], [0, 0, 1, 1] * 300]
    steps = Steps.of(np.array(sum(sequences, [])), np.array([len(x) for x in sequences]))
    got, want = expect(steps, single), expect(steps, double)
    assert np.allclose(got.first, want.first, rtol=1e-3) and np.allclose(got.move, want.move, rtol=1e-3, atol=1e-3) and np.allclose(got.give, want.give, rtol=1e-3, atol=1e-3)


def plain_scores(rows, shape):
    """The contract's columns, and a model trained text by text in the same rounds."""
    train = [words(t) for i, t in rows if not held(i)]
    c = Counter(w for x in train for w in x)
    n, v = sum(c.values()), len(c)
    share, of, kinds = np.zeros(shape.symbols), Counter(), Counter()
    for w, k in c.items():
        of[symbol_of(w, shape.symbols)] += k
        kinds[symbol_of(w, shape.symbols)] += 1
    used = markov.Usage(n, v, np.array([of[s] for s in range(shape.symbols)]), np.array([kinds[s] for s in range(shape.symbols)]))
    model, share = markov.beginning(shape, used)
    sequences = [[symbol_of(w, shape.symbols) for w in x] for x in train]
    for _ in range(shape.early_rounds + shape.rounds):
        counts = Expected.none(shape.symbols, shape.states)
        for s in sequences:
            f, b = [model.first * model.give[:, s[0]]], [np.ones(shape.states)]
            for x in s[1:]:
                f.append((f[-1] @ model.move) * model.give[:, x])
            for x in reversed(s[1:]):
                b.append(model.move @ (model.give[:, x] * b[-1]))
            b.reverse()
            p = f[-1].sum()
            for t, x in enumerate(s):
                counts.give[:, x] += f[t] * b[t] / p
                if t:
                    counts.move += model.move * np.outer(f[t - 1], model.give[:, x] * b[t]) / p
            counts.first += f[0] * b[0] / p
        model = markov.improved(counts, share, shape.prior)
    out = []
    for i, t in rows:
        w = words(t)
        inner = sum(log10((c[x] + 1) / (of[symbol_of(x, shape.symbols)] + kinds[symbol_of(x, shape.symbols)] + 1)) for x in w)
        hidden = log10(plain_forward([symbol_of(x, shape.symbols) for x in w], model))
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(log10((c[x] + 1) / (n + v + 1)) for x in w), hidden + inner))
    return out


def check(got, want):
    got, want = (sorted((tuple(r) for r in rows), key=repr) for rows in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=2e-4)


def test_equal_to_training_and_scoring_text_by_text(docs, prose):
    rows = [(i, " ".join(prose(3 + i % 11, seed=i))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "ÉCOLE École école"), (104, "A\x0bB\x0cc\x1cd  e"), (104, "A\x0bB\x0cc\x1cd  e"), (None, "no id"), (None, None), (105, "\U0001f600 end")]
    check(score_texts(docs(rows), SMALL).collect(), plain_scores(rows, SMALL))


def test_probabilities_add_up():
    """All continuations of a text with any word of a closed vocabulary, or one unseen word in each class, come to one."""
    symbols = 8
    vocabulary = {b"w%d" % k: k + 1 for k in range(9)} | {markov.END: 4}
    of, kinds = np.zeros(symbols), np.zeros(symbols)
    for w, k in vocabulary.items():
        of[symbol_of(w, symbols)] += k
        kinds[symbol_of(w, symbols)] += 1
    inner = Counter()
    for w, k in vocabulary.items():
        inner[symbol_of(w, symbols)] += (k + 1) / (of[symbol_of(w, symbols)] + kinds[symbol_of(w, symbols)] + 1)
    for s in range(symbols):
        assert inner[s] + 1 / (of[s] + kinds[s] + 1) == pytest.approx(1)


def test_odd_rows_empty_tables_and_no_training_text(spark, docs, odd):
    out = score_texts(docs(odd), SMALL).collect()
    assert sorted(repr(r.doc_id) for r in out) == sorted(repr(i) for i, _ in odd)
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)
    assert score_texts(docs([]), SMALL).collect() == []
    only_held = [(i, "a b") for i in range(60) if held(i)]
    out = score_texts(docs(only_held), SMALL).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out} == {(3, 0, 0, 0.0)}
    wide = docs([(1, "a b"), (2, "c")]).selectExpr("*", "1 AS block", "2 AS n", "'x' AS held", "3 AS words", "4 AS part")
    assert score_texts(wide, SMALL).count() == 2


def test_the_model_does_not_depend_on_how_rows_are_dealt(docs, prose):
    rows = [(i, " ".join(prose(5 + i % 40, seed=i))) for i in range(80)]
    one = {r.doc_id: r.score for r in score_texts(docs(rows).coalesce(1), SMALL).collect()}
    many = {r.doc_id: r.score for r in score_texts(docs(rows).repartition(7), SMALL).collect()}
    assert all(one[i] == pytest.approx(many[i], rel=1e-5) for i in one)


def test_all_rounds_run_over_all_texts_of_millions_of_tokens(spark, tmp_path):
    text = "array_join(transform(sequence(1, 800), i -> 'w' || (i * i * (id % 7 + 1) + id) % 500), ' ')"
    rows = spark.range(0, 3000, 1, 6).selectExpr("id AS doc_id", f"{text} AS text")
    to_blocks(rows, F.lit(False), SMALL, "doc_id", "text").write.parquet(str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    used = usage(vocabulary(blocks, SMALL.symbols), SMALL.symbols)
    assert used.tokens == 3000 * 801 and blocks.count() >= 6
    want, share = markov.beginning(SMALL, used)
    for _ in range(SMALL.early_rounds + SMALL.rounds):
        want = improved(gather(blocks, want), share, SMALL.prior)
    got = fit(blocks, used, SMALL)
    assert all(np.array_equal(getattr(got, x), getattr(want, x)) for x in ("first", "move", "give"))


def test_held_out_texts_of_several_kinds_are_likelier_than_by_single_words(docs, prose):
    """Texts draw on one of four vocabularies, which single words cannot tell and states can."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{'abcd'[i % 4]}{k}" for k in rng.zipf(1.3, 40) % 200)) for i in range(600)]
    out = score_texts(docs(rows), Shape(states=6, symbols=4096, prior=50.0)).where("held_out").collect()
    assert len(out) > 50
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
