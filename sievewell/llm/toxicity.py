"""Toxicity by a weighted finite-state pattern grammar.

A lexicon turns words into symbols: insult, threat, target, negation, reported
speech, anything else; a word may be read as several.  Its word lists are
short fixed ones, joined by words and word beginnings that labelled texts show
to be insults in whatever language.  Five transducers, each a table of states
by symbols, are composed into one: reported speech and negation mark the
insults and threats within their reach, the target transducer those aimed at
somebody, and the insult and threat transducers write what they then find.
Each arc weighs what it writes; the weights are fitted on labelled texts.  A
clause is scored by its best path, a text by the paths of all its clauses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievewell.llm.sampling import fold, labelled_texts
from sievewell.llm.store import stored
from sievewell.llm.words import Words, cut, runs, slices

# The words each symbol starts out with.
INSULTS = "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown clowns fool fools jerk vermin".split()
THREATS = "kill hurt destroy beat shoot stab burn hang punish".split()
TARGETS = "you your yours he him his she her they them their this these those".split()
NEGATIONS = "not no never neither nor isn aren don doesn didn without".split()
REPORTS = "said says say claimed claims wrote writes quoted quotes told reported reports according".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATION_REACH = 3
CONTEXTS = ("plain", "targeted", "negated", "reported")
OUTPUTS = tuple(f"{what}/{how}" for what in ("insult", "threat") for how in CONTEXTS) + ("target after insult",)
# An insult or threat found in a context is a symbol of its own, written by one transducer for the next to read.
_HEAVY = {(what, how): what if not how else 6 + 3 * i + how - 1 for i, what in enumerate((INSULT, THREAT)) for how in range(4)}
_SYMBOLS = 12

#: Labelled texts to learn from, at most.
MOST_LABELLED = 20_000
#: A word or beginning is an insult if it is in so many toxic texts at least, and so many times likelier there.
LEAST_TEXTS = 6
LEAST_ODDS = 40.0
BEGINNINGS = (4, 5, 6)

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_CLAUSE_END = np.zeros(256, dtype=bool)
_CLAUSE_END[[ord(c) for c in ".!?;\n"]] = True
_SCORE_SCHEMA = "doc_id bigint, score double"


def _hash_of(words: list[str]) -> np.ndarray:
    return cut([" ".join(words).encode()], _LETTERS).hashes()


def _unit_hashes(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of whole words, then of their beginnings; each with the words concerned."""
    everything = np.arange(len(words.start))
    yield everything, words.hashes()
    length = words.end - words.start
    for size in BEGINNINGS:
        longer = np.flatnonzero(length > size)
        start = words.start[longer]
        beginning = Words(words.data, start, start + size, np.array([0, len(start)]))
        yield longer, beginning.hashes() ^ np.uint64(size)


@dataclass(frozen=True)
class Transducer:
    """Arcs by state and symbol read: the next state, the symbol written, and how often each of ``OUTPUTS`` is put out."""

    to: np.ndarray
    writes: np.ndarray
    puts: np.ndarray

    @classmethod
    def of(cls, states: int, arcs: dict[tuple[int, int], tuple[int, int] | tuple[int, int, int]], fades: bool = False) -> Transducer:
        """``arcs`` maps (state, symbol) to (next state, symbol written[, output]).

        Any other symbol is written as it was read; the state stays, or, if it ``fades``, falls by one.
        """
        here = np.arange(states)
        to = np.repeat((np.maximum(here - 1, 0) if fades else here)[:, None], _SYMBOLS, axis=1)
        writes = np.repeat(np.arange(_SYMBOLS)[None, :], states, axis=0)
        puts = np.zeros((states, _SYMBOLS, len(OUTPUTS)))
        for (state, symbol), (to[state, symbol], writes[state, symbol], *output) in arcs.items():
            puts[state, symbol, output] = 1
        return cls(to, writes, puts)

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes. State (i, j) is i * (states of other) + j."""
        m = len(other.to)
        i, j = np.divmod(np.arange(len(self.to) * m), m)
        between = self.writes[i]
        j = j[:, None]
        return Transducer(self.to[i] * m + other.to[j, between], other.writes[j, between], self.puts[i] + other.puts[j, between])


def _marking(how: int, states: tuple[int, ...]) -> dict[tuple[int, int], int]:
    return {(state, what): _HEAVY[what, how] for state in states for what in (INSULT, THREAT)}


def _putting(what: int) -> Transducer:
    first = 0 if what == INSULT else len(CONTEXTS)
    return Transducer.of(1, {(0, _HEAVY[what, how]): (0, OTHER, first + how) for how in range(4)})


def grammar_parts() -> tuple[Transducer, ...]:
    """Reported speech, negation, target, insult and threat, in the order in which they are composed."""
    reported = Transducer.of(2, {(0, REPORT): (1, OTHER), **{k: (1, w) for k, w in _marking(3, (1,)).items()}})
    reach = range(1, NEGATION_REACH + 1)
    negation = Transducer.of(
        NEGATION_REACH + 1,
        {(s, NEGATION): (NEGATION_REACH, OTHER) for s in (0, *reach)} | {k: (k[0] - 1, w) for k, w in _marking(2, tuple(reach)).items()},
        fades=True,
    )
    # 0: nothing yet, 1: somebody is named, 2: an insult or threat, and nobody named so far.
    target = Transducer.of(
        3,
        {(0, TARGET): (1, OTHER), (1, TARGET): (1, OTHER), (2, TARGET): (1, OTHER, OUTPUTS.index("target after insult"))}
        | {(0, symbol): (2, symbol) for symbol in _HEAVY.values()}
        | {k: (1, w) for k, w in _marking(1, (1,)).items()},
    )
    return reported, negation, target, _putting(INSULT), _putting(THREAT)


COMPOSED = reduce(Transducer.then, grammar_parts())
_NO_PATH = -1e30
#: Clauses walked at once, which bounds the memory of a walk.
_CLAUSES = 2048


@dataclass
class Grammar:
    """Learned insults (sorted hashes of words and beginnings), a weight per output with the constant last, and the transducer."""

    learned: np.ndarray
    weights: np.ndarray
    machine: Transducer = COMPOSED

    def readings(self, words: Words) -> np.ndarray:
        """The symbols each word may be read as, a bit each; 0 for none but ``OTHER``."""
        out = np.zeros(len(words.start), dtype=np.uint8)
        learned = self.learned
        for which, hashes in _unit_hashes(words):
            if len(learned):
                at = np.searchsorted(learned, hashes)
                out[which[learned[np.minimum(at, len(learned) - 1)] == hashes]] |= np.uint8(1 << INSULT)
        hashes = words.hashes()
        for symbol, listed in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            known = np.sort(_hash_of(listed))
            out[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes] |= np.uint8(1 << symbol)
        return out

    @cached_property
    def _steps(self) -> tuple[np.ndarray, np.ndarray]:
        """Per set of readings, from state to state: the weight of the best arc and what it puts out."""
        states = len(self.machine.to)
        weight = np.full((1 << 6, states, states), _NO_PATH)
        puts = np.zeros((1 << 6, states, states, len(OUTPUTS)))
        arc_weight = self.machine.puts @ self.weights[:-1]
        for readings in range(1 << 6):
            for symbol in [s for s in range(1, 6) if readings >> s & 1] or [OTHER]:
                for state in range(states):
                    to = self.machine.to[state, symbol]
                    if arc_weight[state, symbol] > weight[readings, state, to]:
                        weight[readings, state, to] = arc_weight[state, symbol]
                        puts[readings, state, to] = self.machine.puts[state, symbol]
        return weight, puts

    def _walk(self, readings: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What the best path through each clause puts out; clause i reads readings[start[i]:start[i] + length[i]], longest first."""
        weight, puts = self._steps
        states = len(self.machine.to)
        best = np.full((len(start), states), _NO_PATH)
        best[:, 0] = 0
        out = np.zeros((len(start), states, len(OUTPUTS)))
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -t, side="left"))
            read = readings[start[:live] + t]
            paths = best[:live, :, None] + weight[read]
            source = paths.argmax(axis=1)
            best[:live] = np.take_along_axis(paths, source[:, None, :], axis=1)[:, 0]
            rows = np.arange(live)[:, None]
            out[:live] = out[rows, source] + puts[read[:, None], source, np.arange(states)]
        return out[np.arange(len(start)), best.argmax(axis=1)]

    def outputs(self, texts: list[bytes | None]) -> np.ndarray:
        """What the best paths through each text's clauses put out."""
        words = cut(texts, _LETTERS)
        counts = np.zeros((len(texts), len(OUTPUTS)))
        readings = self.readings(words)
        heavy = readings & (1 << INSULT | 1 << THREAT) != 0
        if not heavy.any():
            return counts
        doc = words.doc
        clause = np.cumsum(_CLAUSE_END[words.data])[words.start]
        at = np.flatnonzero(np.isin(clause, clause[heavy]))
        # Beyond the reach of a negation another word without a symbol changes no state.
        symbol = np.flatnonzero(readings != 0)
        since = at - symbol[np.maximum(np.searchsorted(symbol, at, side="right") - 1, 0)]
        at = at[(readings[at] != 0) | (since <= NEGATION_REACH)]
        of, start, length = np.unique(clause[at], return_index=True, return_counts=True)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        read = readings[at]
        for i in range(0, len(order), _CLAUSES):
            part = slice(i, i + _CLAUSES)
            np.add.at(counts, doc[at[start[part]]], self._walk(read, start[part], length[part]))
        return counts

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(counts @ self.weights[:-1] + self.weights[-1], -40, 40)))


#: Used until there are labels of both kinds: one plain or targeted insult or threat is toxic, not a negated or reported one.
PRIOR_WEIGHTS = np.array([6.0, 8.0, 1.0, 1.0, 4.0, 8.0, 1.0, 1.0, 2.0, -3.0])


def _unalike(rows: DataFrame) -> DataFrame:
    """Labelled texts with most near copies left out, as copies prove nothing twice: one per label and least shingle of two kinds.

    The one with the least id stays, so that the same rows teach every time.
    """

    def least(batches):
        for batch in batches:
            for part, texts in slices(batch):
                words = cut(texts, _LETTERS)
                shingles, bounds = runs(words.hashes(), words.first, 3)
                both = []
                for turn in (np.uint64(0), np.uint64(0x5DEECE66D1234567)):
                    own = np.zeros(len(texts), dtype=np.int64)
                    for d in range(len(texts)):
                        own[d] = (shingles[bounds[d] : bounds[d + 1]] ^ turn).min(initial=np.uint64(2**64 - 1)).astype(np.int64)
                    both.append(pa.array(own))
                yield pa.RecordBatch.from_arrays([*part.columns, *both], names=["doc_id", "text", "label", "m1", "m2"])

    marked = rows.select("doc_id", "text", "label").mapInArrow(least, "doc_id bigint, text string, label int, m1 bigint, m2 bigint")
    for least_shingle in ("m1", "m2"):
        rank = F.row_number().over(W.partitionBy(least_shingle, "label").orderBy("doc_id", "text"))
        marked = marked.withColumn("rank", rank).where("rank = 1").drop("rank")
    return marked.select("doc_id", "text", "label")


def _learn_insults(rows: DataFrame) -> np.ndarray:
    """Hashes of words and beginnings that are in toxic texts far more often than in others."""

    def units(batches):
        for batch in batches:
            for part, texts in slices(batch):
                words = cut(texts, _LETTERS)
                toxic = np.asarray(part.column(1)) == 1
                doc = words.doc
                seen = np.concatenate([np.stack([doc[which].astype(np.uint64), hashes], axis=1) for which, hashes in _unit_hashes(words)])
                seen = np.unique(seen, axis=0)
                unit, place = np.unique(seen[:, 1], return_inverse=True)
                is_toxic = toxic[seen[:, 0].astype(np.int64)]
                n, pos = np.bincount(place, minlength=len(unit)), np.bincount(place, weights=is_toxic, minlength=len(unit))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit.view(np.int64)), pa.array(pos.astype(np.int64)), pa.array(n.astype(np.int64) - pos.astype(np.int64))],
                    names=["unit", "toxic", "other"],
                )

    totals = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, other = (totals[0] or 0), (totals[1] or 0)
    counted = rows.select("text", "label").mapInArrow(units, "unit bigint, toxic bigint, other bigint").groupBy("unit").agg(
        F.sum("toxic").alias("t"), F.sum("other").alias("o")
    )
    odds = ((F.col("t") + 0.5) / (toxic + 1.0)) / ((F.col("o") + 0.5) / (other + 1.0))
    # No more than the toxic texts of the sample hold.
    found = counted.where((F.col("t") >= LEAST_TEXTS) & (odds >= LEAST_ODDS)).select("unit").toArrow()
    return np.sort(np.asarray(found.column("unit"), dtype=np.int64).view(np.uint64))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Weights and, last, a constant; Newton steps on the ridge-penalised likelihood."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_grammar(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> Grammar:
    """Learn insults on one half of a bounded labelled sample, weights on the other."""
    rows = stored(_unalike(labelled_texts(documents, labels, label, folds, held_out, most, doc_id, text)), "toxic-sample")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    learned = _learn_insults(rows.where(half == 0))
    grammar = Grammar(learned, PRIOR_WEIGHTS)

    def written(batches):
        for batch in batches:
            for part, texts in slices(batch):
                counts = grammar.outputs(texts)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(list(counts), pa.list_(pa.float64()))], names=["label", "counts"])

    seen = rows.where(half == 1).select("text", "label").mapInArrow(written, "label int, counts array<double>")
    # Equal counts are one row here, so that the driver gets few of the sample's rows.
    table = seen.groupBy("counts", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    if len({r.label for r in table}) < 2:
        return grammar
    x = np.array([r.counts for r in table])
    y, n = np.array([r.label for r in table], dtype=float), np.array([r.n for r in table])
    return Grammar(learned, fit_logistic(np.repeat(x, n, axis=0), np.repeat(y, n), ridge=0.1))


def score_toxicity(documents: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) per document; NULL and empty texts score as texts without a match, repeated rows alike."""
    shared = documents.sparkSession.sparkContext.broadcast(grammar)

    def score(batches):
        for batch in batches:
            for rows, texts in slices(batch):
                own = shared.value
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(own.scores(own.outputs(texts)))], names=["doc_id", "score"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(score, _SCORE_SCHEMA)


def drop_toxic(documents: DataFrame, grammar: Grammar, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """``documents`` without those that score ``threshold`` or more; all columns stay and nothing is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(grammar)

    def keep(batches):
        for batch in batches:
            for rows, texts in slices(batch, text):
                yield rows.filter(pa.array(shared.value.scores(shared.value.outputs(texts)) < threshold))

    return documents.mapInArrow(keep, documents.schema)


def judge_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.5, **columns) -> DataFrame:
    """doc_id, held_out (fold 0 of ``folds``), score and predicted (1 from ``threshold`` on) per document.

    Labels are read only outside the held-out fold.  Without labels of both
    kinds the fixed words and weights are used.  An empty table gives none.
    """
    grammar = fit_grammar(documents, labels, folds=folds, **columns)
    scored = score_toxicity(documents, grammar, **columns)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
