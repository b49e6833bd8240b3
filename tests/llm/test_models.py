from __future__ import annotations

import itertools
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewell.llm import factorisation, queries, segmentation, toxicity
from sievewell.llm.toxicity import Grammar, PRIOR_WEIGHTS, judge_toxicity
from sievewell.llm.words import cut

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
needs_pieces = pytest.mark.skipif(not os.path.exists(segmentation.VOCABULARY), reason="no vocabulary file")
LABELS = "doc_id bigint, quality int, toxic int"


def held_out_accuracy(spark, name, label):
    scored = queries.queries()[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select(label, "predicted").collect()
    return sum(a == b for a, b in rows) / len(rows)


@needs_tables
def test_toxicity_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "op10_toxicity", "toxic") > 0.95


@needs_tables
def test_quality_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "op6_quality_classifier", "quality") > 0.9


@needs_tables
@needs_pieces
def test_languages_of_held_out_texts(spark):
    found = queries.queries()["op5_language_id"](spark, SF_DIR).where("held_out")
    rows = found.join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id").select("lang", "lang_pred").collect()
    assert sum(a == b for a, b in rows) / len(rows) > 0.97


def test_contexts_of_insults():
    grammar = Grammar(np.zeros(0, np.uint64), PRIOR_WEIGHTS)
    count = lambda t: dict(zip(toxicity.OUTPUTS, grammar.outputs([t.encode()])[0]))
    assert count("what an idiot")["insult/plain"] == 1
    assert count("you are an idiot")["insult/targeted"] == 1
    assert count("you are not an idiot")["insult/negated"] == 1
    assert count("not so, so very much an idiot")["insult/plain"] == 1
    assert count("she said he is an idiot")["insult/reported"] == 1
    assert count("she said so. idiot")["insult/plain"] == 1
    assert count("i will kill you")["threat/plain"] == 1 and count("i will kill you")["target after insult"] == 1
    plain, targeted, negated, reported, none = grammar.scores(grammar.outputs([b"idiot", b"you idiot", b"no idiot", b"they said idiot", None]))
    assert targeted > plain > 0.5 > negated and reported < 0.5 and none < 0.1


def test_toxicity_without_labels_and_with_odd_rows(spark, docs, odd):
    rows = [*odd, (50, "You are a worthless idiot")]
    none = spark.createDataFrame([], LABELS)
    got = judge_toxicity(docs(rows).withColumn("score", F.lit("mine")), none).collect()
    assert len(got) == len(rows) and [r.predicted for r in got if r.doc_id == 50] == [1]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert judge_toxicity(docs([]), none).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(spark, docs, prose):
    rows = [(i, " ".join(["grobbel"] * (i % 2) + prose(15, i))) for i in range(400)]
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(400)], LABELS)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted(judge_toxicity(docs(rows), labels).collect())
    assert one == sorted(judge_toxicity(docs(rows), flipped).collect())
    assert all(r.predicted == r.doc_id % 2 for r in one)


def test_the_machine_sums_all_pairs():
    machine = factorisation.Machine.fresh()
    machine.table[:, 0] = np.random.default_rng(3).normal(size=len(machine.table))
    slots, amounts, first = factorisation.features([b"some Words, some words", None, b"x"], np.array([22.0, 0.0, 1.0]))
    got = machine.raw_scores(slots, amounts, first)
    for d in range(3):
        inputs = list(zip(slots[first[d] : first[d + 1]], amounts[first[d] : first[d + 1]].astype(float)))
        want = sum(machine.table[s, 0] * x for s, x in inputs)
        want += sum(machine.table[s, 1:] @ machine.table[t, 1:] * x * y for (s, x), (t, y) in itertools.combinations(inputs, 2))
        assert math.isclose(got[d], want, rel_tol=1e-6, abs_tol=1e-9)


def test_gradient_steps_follow_the_loss():
    machine = factorisation.Machine.fresh()
    inputs = factorisation.features([b"good good words here", b"bad %%% &&& ***"] * 8, np.zeros(16))
    y, memory = np.array([1.0, 0.0] * 8), np.full_like(machine.table, 1e-4)
    for _ in range(30):
        machine.step(*inputs, y, memory, 0.1)
    raw = machine.raw_scores(*inputs)
    assert (raw[::2] > 1).all() and (raw[1::2] < -1).all()


def test_quality_without_labels_and_with_odd_rows(spark, docs, odd):
    none = spark.createDataFrame([], LABELS)
    got = factorisation.judge_quality(docs(odd).drop("n_chars"), none).collect()
    assert len(got) == len(odd) and all(r.score == 0.5 and r.predicted == 1 for r in got)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)], LABELS)
    rows = [(i, "fine words of prose" if i % 2 else "%%% ### ***") for i in range(60)] + odd
    got = factorisation.judge_quality(docs(rows).withColumn("n_chars", F.lit("text")), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert factorisation.judge_quality(docs([]), none).count() == 0


def enumerated(word, p, pieces):
    if not word:
        return 1.0
    return sum(p[pieces.index(word[:n])] * enumerated(word[n:], p, pieces) for n in range(1, len(word) + 1) if word[:n] in pieces)


def lattice_of(pieces, words):
    found = cut([b" ".join(words)], segmentation._LETTERS)
    return segmentation.Lattice.of(segmentation.Pieces(pieces), found.data, found.start, found.end)


def test_the_forward_pass_sums_all_segmentations():
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"cab"]
    p = np.random.default_rng(2).random(len(pieces))
    words = [b"abcab", b"a", b"cabcabc", b"zz", b"bc"]
    got = lattice_of(pieces, words).log_scores(p[:, None])[:, 0]
    assert np.allclose(got, [math.log(enumerated(w, p, pieces)) for w in words])


def test_long_words_pieces_and_scripts_without_spaces_are_summed_whole():
    run = "自然言語処理の研究が進んでいる".encode()
    pieces = [bytes([b]) for b in range(256)] + [" 自".encode(), "自然".encode(), "言語処理の研究".encode(), b"ab", b"abcdefghijkl", run[3:40]]
    p = np.random.default_rng(3).random((len(pieces), 2)) / 50
    words = [b" " + run, run * 3, b"abcdefghijkl" * 3, b"abcdefghijkl", b"ab" * 700]
    joined = b"".join(words)
    ends = np.cumsum([len(w) for w in words])

    def plain(word, g):
        # Scaled by a constant per byte, so that plain products do not vanish.
        sums = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            sums[j] = sum(sums[j - len(q)] * p[i, g] * 8.0 ** len(q) for i, q in enumerate(pieces) if word[:j].endswith(q))
        return math.log(sums[-1]) - len(word) * math.log(8)

    got = np.zeros((len(words), 2))
    data, starts = np.frombuffer(joined, np.uint8), ends - [len(w) for w in words]
    for block in segmentation.blocks(ends - starts, 2):
        got[block] = segmentation.Lattice.of(segmentation.Pieces(pieces), data, starts[block], ends[block]).log_scores(p)
    assert np.allclose(got, [[plain(w, g) for g in range(2)] for w in words])


def test_words_are_whole_runs_with_their_space():
    text = "Ab cd,ef " + "中" * 40
    words = segmentation._letter_words(segmentation._lowered([text.encode(), None, b"x"]))
    assert [words.data[s:e].tobytes().decode() for s, e in zip(words.start, words.end)] == ["ab", " cd", "ef", " " + "中" * 40, "x"]


@needs_pieces
def test_no_usable_piece_is_left_out():
    pieces = set(segmentation.read_vocabulary())
    assert len(pieces) > 39_000 and max(map(len, pieces)) > 30 and " the".encode() in pieces


def test_expectations_count_the_bytes():
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"cab"]
    p = np.random.default_rng(2).random(len(pieces))
    for words in ([b"abcab", b"cabcabc"], [b"abcab" * 30, b"cabcabc" * 40]):
        used = lattice_of(pieces, words).expected(p / p.sum(), np.array([2.0, 3.0]))
        assert math.isclose(sum(n * len(q) for n, q in zip(used, pieces)), 2 * len(words[0]) + 3 * len(words[1]))


@needs_pieces
def test_languages_with_odd_rows(spark, docs, odd):
    rows = [(100 + i, f"the house of the king number{i} is there") for i in range(60)] + [(200 + i, f"das haus des königs ist nummer{i} und groß") for i in range(60)]
    frame = docs(rows).withColumn("lang", F.when(F.col("doc_id") < 200, "en").otherwise("de"))
    frame = frame.unionByName(docs(odd + [(900, "123 !!"), (901, "DAS HAUS IST GROSS"), (902, "中文")]))
    got = {r.doc_id: r for r in segmentation.predict_languages(frame.withColumn("lang_pred", F.lit(1))).collect()}
    assert got[900].lang_pred == got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[900].score == 0
    assert got[901].lang_pred == "de" and got[902].lang_pred in ("de", "en") and 0 < got[902].score <= 1
    assert all(got[i].lang_pred == ("en" if i < 200 else "de") for i, _ in rows)
    assert segmentation.predict_languages(docs([])).count() == 0
    assert {r.lang_pred for r in segmentation.predict_languages(docs(odd)).collect()} == {"und"}
