"""Quality scores by a factorisation machine.

Inputs are hashed words, structure statistics and the metadata column n_chars,
each statistic cut into fixed bins.  Every input has a weight and a short
vector, and a pair of inputs contributes the product of its vectors.  All
pairs are summed in linear time as half of (square of the sum minus sum of the
squares).  Training passes run on Spark over a bounded labelled sample: each
partition takes gradient steps from the same model, and their results are
averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.sampling import fold, labelled_texts
from sievewell.llm.store import stored
from sievewell.llm.words import NOT_SPACE, cut, slices

WORD_SLOTS = 1 << 14
FACTORS = 6
#: Labelled texts to learn from, at most, in so many partitions; passes over them.
MOST_LABELLED = 20_000
PARTITIONS = 6
PASSES = 6
BATCH = 16
_SCORE_SCHEMA = "doc_id bigint, score double"

# Upper bounds of the bins of each statistic; a value beyond the last has a bin of its own.
_SHARES = (0.0, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5)
STATISTICS = {
    "words": (0, 3, 10, 30, 100, 300, 1000, 3000),
    "characters": (0, 20, 60, 200, 600, 2000, 6000, 20000),
    "mean word length": (1, 2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15),
    "distinct words": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99),
    "words equal to the one before": _SHARES,
    "symbols": _SHARES,
    "capitals": _SHARES,
    "digits": _SHARES,
    "line ends": _SHARES,
    "words ending in a symbol": _SHARES,
    "n_chars": (0, 20, 60, 200, 600, 2000, 6000, 20000),
}
_OFFSETS = WORD_SLOTS + np.concatenate([[0], np.cumsum([len(b) + 1 for b in STATISTICS.values()])])
SLOTS = int(_OFFSETS[-1])
#: How much all words together count, beside 1 for each statistic.
WORDS_WEIGHT = 1.0

_SYMBOL, _CAPITAL, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(3))
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[]\\^_`{|}~!"]] = True
_DIGIT[0x30:0x3A] = True


def features(texts: list[bytes | None], n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of each text's inputs, one text after another, and where each text begins.

    Case is read from the bytes as they are; of two-byte characters the Latin
    capitals count.
    """
    words = cut(texts, NOT_SPACE)
    n = np.diff(words.first)
    doc = words.doc
    hashes = words.hashes()
    raw = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", dtype=np.uint8)
    sizes = np.fromiter((len(t or b"") for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[ends - 1] - total[starts]

    capital = (raw >= 0x41) & (raw <= 0x5A)
    capital[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    characters = per_text((raw & 0xC0) != 0x80)
    distinct = np.unique(np.stack([doc.astype(np.uint64), hashes], axis=1), axis=0)
    n_distinct = np.bincount(distinct[:, 0].astype(np.int64), minlength=len(texts))
    repeated = np.zeros(len(hashes), dtype=bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    symbol_end = _SYMBOL[words.data[words.end - 1]] if len(hashes) else np.zeros(0, bool)
    some, chars = np.maximum(n, 1), np.maximum(characters, 1)
    count = lambda flags: np.bincount(doc, weights=flags, minlength=len(texts))
    values = [
        n, characters, (characters - n) / some, n_distinct / some, count(repeated) / some,
        per_text(_SYMBOL[raw]) / chars, per_text(capital) / chars, per_text(_DIGIT[raw]) / chars, per_text(raw == 10) / chars,
        count(symbol_end) / some, n_chars,
    ]
    bins = np.stack([np.searchsorted(bounds, v, side="left") for bounds, v in zip(STATISTICS.values(), values)], axis=1)
    bins = np.minimum(bins, np.diff(_OFFSETS) - 1) + _OFFSETS[:-1]
    lengths = n_distinct + bins.shape[1]
    first = np.concatenate(([0], np.cumsum(lengths)))
    slots, amounts = np.empty(first[-1], np.int32), np.empty(first[-1], np.float32)
    at = (first[:-1, None] + np.arange(bins.shape[1])).ravel()
    slots[at], amounts[at] = bins.ravel(), 1.0
    is_word = np.ones(first[-1], dtype=bool)
    is_word[at] = False
    slots[is_word] = (distinct[:, 1] >> np.uint64(20)).astype(np.int64) & (WORD_SLOTS - 1)
    amounts[is_word] = np.repeat(WORDS_WEIGHT / np.maximum(n_distinct, 1), n_distinct)
    return slots, amounts, first


@dataclass
class Machine:
    """``table`` has a row per slot: its weight, then its vector."""

    constant: float
    table: np.ndarray

    @classmethod
    def fresh(cls) -> Machine:
        table = np.random.default_rng(1).normal(0, 0.05, (SLOTS, 1 + FACTORS))
        table[:, 0] = 0
        return cls(0.0, table)

    def raw_scores(self, slots: np.ndarray, amounts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The sum-of-squares identity, text by text; no text is without inputs."""
        rows = self.table[slots] * amounts[:, None]
        total = np.add.reduceat(rows, first[:-1], axis=0)
        squares = np.add.reduceat(rows[:, 1:] ** 2, first[:-1], axis=0)
        return self.constant + total[:, 0] + 0.5 * (total[:, 1:] ** 2 - squares).sum(axis=1)

    def step(self, slots: np.ndarray, amounts: np.ndarray, first: np.ndarray, y: np.ndarray, memory: np.ndarray, rate: float) -> None:
        """One gradient step on a few texts; ``memory`` keeps squared gradients per number."""
        rows = self.table[slots] * amounts[:, None]
        total = np.add.reduceat(rows[:, 1:], first[:-1], axis=0)
        error = 1 / (1 + np.exp(-np.clip(self.raw_scores(slots, amounts, first), -30, 30))) - y
        of = np.repeat(np.arange(len(y)), np.diff(first))
        gradient = np.empty_like(rows)
        gradient[:, 0] = amounts * error[of]
        gradient[:, 1:] = (amounts * error[of])[:, None] * (total[of] - rows[:, 1:])
        summed = np.zeros_like(self.table)
        np.add.at(summed, slots, gradient)
        touched = np.unique(slots)
        g = summed[touched] / len(y) + 1e-6 * self.table[touched]
        memory[touched] += g * g
        self.table[touched] -= rate * g / np.sqrt(memory[touched] + 1e-8)
        self.constant -= rate * 0.1 * error.mean()


def _size(documents: DataFrame, n_chars: str):
    """The metadata column as a number; 0 where it is NULL, no number or not there."""
    return (F.coalesce(F.col(n_chars).try_cast("double"), F.lit(0.0)) if n_chars in documents.columns else F.lit(0.0)).alias("n_chars")


def fit_machine(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", most: int = MOST_LABELLED) -> Machine | None:
    """None if the sample has no labels of both kinds."""
    rows = labelled_texts(documents, labels, label, folds, held_out, most, doc_id, text, _size(documents, n_chars))

    def prepare(batches):
        for batch in batches:
            for part, texts in slices(batch):
                slots, amounts, first = features(texts, np.asarray(part.column(1), dtype=float))
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(slots)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(amounts))],
                    names=["label", "slots", "amounts"],
                )

    prepared = rows.select("text", "n_chars", "label").mapInArrow(prepare, "label int, slots array<int>, amounts array<float>")
    prepared = stored(prepared.repartition(PARTITIONS, F.xxhash64("slots")), "quality-sample")
    kinds = prepared.groupBy("label").count().collect()
    if len(kinds) < 2:
        return None
    machine = Machine.fresh()
    share = sum(r["count"] for r in kinds if r.label == 1) / sum(r["count"] for r in kinds)
    machine.constant = float(np.log(share / (1 - share)))
    spark = documents.sparkSession
    for turn in range(PASSES):
        shared = spark.sparkContext.broadcast(machine)

        def learn(batches, shared=shared, turn=turn):
            own = Machine(shared.value.constant, shared.value.table.copy())
            memory = np.full_like(own.table, 1e-4)
            seen = np.zeros(SLOTS)
            total = 0
            for batch in batches:
                y = np.asarray(batch.column(0), dtype=float)
                order = np.random.default_rng(turn).permutation(len(y))
                for at in range(0, len(y), BATCH):
                    some = batch.take(pa.array(np.sort(order[at : at + BATCH])))
                    first = np.asarray(some.column(1).offsets, dtype=np.int64)
                    slots, amounts = np.asarray(some.column(1).flatten()), np.asarray(some.column(2).flatten())
                    own.step(slots, amounts, first - first[0], np.asarray(some.column(0), dtype=float), memory, rate=0.1)
                    seen[slots] += 1
                total += len(y)
            if total:
                used = np.flatnonzero(seen)
                table = own.table[used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(used, SLOTS).astype(np.int32)), pa.array(np.append(seen[used], total)), pa.array([*table, np.full(1 + FACTORS, own.constant)], pa.list_(pa.float64()))],
                    names=["slot", "seen", "numbers"],
                )

        learnt = prepared.mapInArrow(learn, "slot int, seen double, numbers array<double>")
        means = [(F.sum(F.col("seen") * F.col("numbers")[i]) / F.sum("seen")).alias(f"x{i}") for i in range(1 + FACTORS)]
        # A row per slot at most: as large as the model.
        new = learnt.groupBy("slot").agg(*means).toArrow()
        slot = np.asarray(new.column("slot"))
        numbers = np.stack([np.asarray(new.column(f"x{i}")) for i in range(1 + FACTORS)], axis=1)
        table = machine.table.copy()
        table[slot[slot < SLOTS]] = numbers[slot < SLOTS]
        machine = Machine(float(numbers[slot == SLOTS][0, 0]), table)
    return machine


def judge_quality(documents: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out (fold 0 of ``folds``), score and predicted (1 from ``threshold`` on) per document.

    Labels are read only outside the held-out fold; NULL and empty texts score
    by their statistics.  Without labels of both kinds every score is 0.5.
    Repeated rows score alike; an empty table gives no rows.
    """
    machine = fit_machine(documents, labels, folds=folds, doc_id=doc_id, text=text, n_chars=n_chars, most=most)
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    def score(batches):
        for batch in batches:
            for rows, texts in slices(batch):
                own = shared.value
                if own is None:
                    scores = np.full(len(texts), 0.5)
                else:
                    raw = own.raw_scores(*features(texts, np.asarray(rows.column(2), dtype=float)))
                    scores = 1 / (1 + np.exp(-np.clip(raw, -40, 40)))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores)], names=["doc_id", "score"])

    inputs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), _size(documents, n_chars))
    scored = inputs.mapInArrow(score, _SCORE_SCHEMA)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
