"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary, given as a file of base64
pieces with ranks.  Each language has a probability per piece; the
probability of a word (a whole run of letters, with the space before it) is
the sum over every way of cutting it into pieces, which a forward pass
computes in time linear in its length.  Probabilities are fitted
by expectation maximisation (forward and backward passes) on the words of a
bounded labelled sample, whose counts Spark gathers and whose expectations it
sums.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.sampling import fold
from sievewell.llm.store import stored
from sievewell.llm.words import Words, cut, mix, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Up to so many bytes probabilities are multiplied as they are; longer words are summed as logarithms.
SHORT_WORD = 25
#: Bytes of words times languages that are worked on at once (a word is never cut).
BLOCK = 1 << 20
#: Labelled texts to learn from, at most, and rounds of expectation maximisation.
MOST_LABELLED = 8_000
ROUNDS = 3
#: A model holds a probability for each piece and language, so it is refused beyond so many languages.
MOST_LANGUAGES = 1_000
UNKNOWN = "und"
#: Words whose scores a worker remembers.
REMEMBERED = 200_000

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_BASE = np.uint64(0x2545F4914F6CDD1D)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces that can be part of a word: letters, at most with a space before them; and every single byte, so that each word has a segmentation."""
    with open(path, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file if line.strip()}
    bare = {p: p.removeprefix(b" ") for p in pieces}
    usable = {p for p, letters in bare.items() if len(p) > 1 and letters and _LETTERS[np.frombuffer(letters, np.uint8)].all()}
    return [bytes([b]) for b in range(256)] + sorted(usable)


class Pieces:
    """Finds pieces by hash: tables of slots, a piece whose slot is taken goes to the next table."""

    def __init__(self, pieces: list[bytes]):
        self.count = len(pieces)
        self.sizes = sorted({len(p) for p in pieces})
        self.hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.tables: list[np.ndarray] = []
        left = np.arange(self.count)
        while len(left):
            slot = self._slot(self.hashes[left], len(self.tables))
            taken, where = np.unique(slot, return_index=True)
            table = np.full(1 << 18, -1, dtype=np.int32)
            table[taken] = left[where]
            self.tables.append(table)
            left = np.delete(left, where)

    @staticmethod
    def _hash(piece: bytes) -> int:
        total = 0
        for b in piece:
            total = (total * int(_BASE) + int(_BYTES[b])) % 2**64
        return total

    @staticmethod
    def _slot(hashes: np.ndarray, table: int) -> np.ndarray:
        return (mix(hashes + np.uint64(table)) >> np.uint64(46)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, ``count`` where there is none."""
        out = np.full(len(hashes), self.count, dtype=np.int32)
        left = np.arange(len(hashes))
        for i, table in enumerate(self.tables):
            piece = table[self._slot(hashes[left], i)]
            found = (piece >= 0) & (self.hashes[piece] == hashes[left])
            out[left[found]] = piece[found]
            left = left[(piece >= 0) & ~found]
        return out


def blocks(length: np.ndarray, languages: int) -> Iterator[np.ndarray]:
    """Words by length in blocks of bounded work, a block's words either all short or all long."""
    order = np.argsort(length, kind="stable")
    filled = np.cumsum(length[order]) * max(languages, 1) // BLOCK * 2 + (length[order] > SHORT_WORD)
    for block in np.split(order, np.flatnonzero(np.diff(filled)) + 1):
        if len(block):
            yield block


@dataclass
class Lattice:
    """Words of one block, and the pieces that end after each number of bytes: ``steps`` holds (end, size, words, pieces), ends rising."""

    length: np.ndarray
    longest: int  # size of the longest piece met
    steps: list[tuple[int, int, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, pieces: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lattice:
        length = end - start
        before = np.cumsum(length) - length
        word = np.repeat(np.arange(len(length)), length)
        at = np.arange(len(word)) - before[word] + 1
        value = _BYTES[data[start[word] + at - 1]]
        most = int(length.max()) if len(length) else 0
        window, met = np.zeros(len(word), np.uint64), []
        for size in range(1, min(most, pieces.sizes[-1]) + 1):
            # Hash of the last ``size`` bytes up to each byte, from that of one byte less.
            window[1:] = window[:-1] * _BASE
            window[:1] = 0
            window += value
            if size in pieces.sizes:
                fits = np.flatnonzero(at >= size)
                piece = pieces.find(window[fits])
                there = piece < pieces.count
                fits = fits[there]
                met.append((at[fits] * np.int64(256) + size, word[fits], piece[there]))
        if not met:
            return cls(length, 1, [])
        key, rows, piece = (np.concatenate(x) for x in zip(*met))
        order = np.argsort(key, kind="stable")
        key, rows, piece = key[order], rows[order], piece[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        steps = [(int(key[i]) >> 8, int(key[i]) & 255, rows[i:j], piece[i:j]) for i, j in zip(edges[:-1], edges[1:])]
        return cls(length, max(size for _, size, _, _ in steps), steps)

    def _linear(self) -> bool:
        return not len(self.length) or self.length.max() <= SHORT_WORD

    def log_scores(self, p: np.ndarray) -> np.ndarray:
        """log probability of every word; ``p`` has a row for each piece.  Only the last ends that a piece can reach back to are kept."""
        linear, kept = self._linear(), self.longest + 1
        q = p if linear else _logs(p)
        nothing, first = (0.0, 1.0) if linear else (-np.inf, 0.0)
        ring = np.full((kept, len(self.length), p.shape[1]), nothing)
        ring[0] = first
        out = np.full(ring.shape[1:], first)
        by_length = np.argsort(self.length, kind="stable")
        ends = np.searchsorted(self.length[by_length], np.arange(int(self.length.max(initial=0)) + 2))
        done = 0
        for end, size, rows, piece in [*self.steps, (len(ends) - 1, 0, None, None)]:
            while done < end:
                ready = by_length[ends[done] : ends[done + 1]]
                out[ready] = ring[done % kept, ready]
                done += 1
                ring[done % kept] = nothing
            if size:
                now, then = ring[end % kept], ring[(end - size) % kept]
                if linear:
                    now[rows] += then[rows] * q[piece]
                else:
                    now[rows] = np.logaddexp(now[rows], then[rows] + q[piece])
        return _logs(out) if linear else out

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words of one language occurring ``weight`` times; ``p`` is that language's."""
        linear, n = self._linear(), np.arange(len(self.length))
        most = int(self.length.max(initial=0))
        q, out = (p if linear else _logs(p)), np.zeros(len(p))
        alpha = np.full((most + 1, len(n)), 0.0 if linear else -np.inf)
        beta = alpha.copy()
        alpha[0] = 1 if linear else 0
        for end, size, rows, piece in self.steps:
            if linear:
                alpha[end, rows] += alpha[end - size, rows] * q[piece]
            else:
                alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[end - size, rows] + q[piece])
        whole = alpha[self.length, n]
        beta[self.length, n] = weight / whole if linear else np.log(weight) - whole
        for end, size, rows, piece in reversed(self.steps):
            if linear:
                use = beta[end, rows] * q[piece]
                beta[end - size, rows] += use
                use = use * alpha[end - size, rows]
            else:
                use = beta[end, rows] + q[piece]
                beta[end - size, rows] = np.logaddexp(beta[end - size, rows], use)
                use = np.exp(use + alpha[end - size, rows])
            np.add.at(out, piece, use)
        return out


def _logs(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(p)


def _lowered(texts: list[bytes | None]) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() if t else b"" for t in texts]


def _letter_words(texts: list[bytes]) -> Words:
    """Runs of letters, whole, each with the space before it if there is one."""
    words = cut(texts, _LETTERS)
    spaced = (words.start > 0) & (words.data[words.start - 1] == ord(" ")) if len(words.start) else np.zeros(0, bool)
    return Words(words.data, words.start - spaced, words.end, words.first)


@dataclass
class Languages:
    """Names in order, the pieces, and a probability per piece and language."""

    names: list[str]
    pieces: Pieces
    p: np.ndarray


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of a labelled sample (text, lang)."""

    def count(batches):
        for batch in batches:
            for part, texts in slices(batch):
                words = _letter_words(_lowered(texts))
                names, lang = np.unique(np.asarray(part.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
                seen = np.stack([lang[words.doc].astype(np.uint64), words.hashes()], axis=1)
                _, at, n = np.unique(seen, axis=0, return_index=True, return_counts=True)
                spelled = [words.data[s:e].tobytes() for s, e in zip(words.start[at], words.end[at])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[lang[words.doc[at]]].tolist(), pa.string()), pa.array(spelled, pa.binary()), pa.array(n)], names=["lang", "word", "n"]
                )

    return rows.select("text", "lang").mapInArrow(count, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_languages(documents: DataFrame, folds: int = 4, held_out: int = 2, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST_LABELLED, vocabulary: str = VOCABULARY) -> Languages:
    """Piece probabilities of every language that labels a document outside the held-out fold.

    A language too rare for the sample is learned all the same, from up to a
    hundredth of ``most`` documents of its own.
    """
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    spark = documents.sparkSession
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; is {lang} a column of languages?")
    totals = {r.lang: r.n for r in found}
    names = sorted(totals)
    keep = max(1.0, sum(totals.values()) / most)
    shares = [(name, int(min(1.0, max(1 / keep, most / 100 / n)) * (1 << 20))) for name, n in totals.items()]
    chance = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    # At most MOST_LANGUAGES rows.
    sample = rows.join(F.broadcast(spark.createDataFrame(shares, "lang string, share bigint")), "lang").where(chance < F.col("share"))
    counts = stored(_word_counts(sample), "language-words")
    pieces = Pieces(read_vocabulary(vocabulary))
    shape = (pieces.count, len(names))
    p = np.full(shape, 1 / pieces.count)
    for _ in range(ROUNDS if names else 0):
        shared = spark.sparkContext.broadcast(Languages(names, pieces, p))

        def expect(batches, shared=shared):
            own = shared.value
            total = np.zeros(own.p.shape)
            for batch in batches:
                language = np.searchsorted(own.names, batch.column(0).to_pylist())
                words = batch.column(1).to_pylist()
                ends = np.cumsum([len(w) for w in words])
                starts, data, n = ends - [len(w) for w in words], np.frombuffer(b"".join(words), np.uint8), np.asarray(batch.column(2))
                for g in np.unique(language):
                    of_g = np.flatnonzero(language == g)
                    for block in blocks(ends[of_g] - starts[of_g], 1):
                        some = of_g[block]
                        total[:, g] += Lattice.of(own.pieces, data, starts[some], ends[some]).expected(own.p[:, g], n[some].astype(float))
            piece, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)), pa.array(total[piece, language])], names=["piece", "language", "n"]
            )

        # As large as the vocabulary times the languages, whatever the input.
        summed = counts.select("lang", "word", "n").mapInArrow(expect, "piece int, language int, n double").groupBy("piece", "language").agg(F.sum("n").alias("n")).toArrow()
        p = np.full(shape, 0.02)
        p[np.asarray(summed.column("piece")), np.asarray(summed.column("language"))] += np.asarray(summed.column("n"))
        p /= p.sum(axis=0)
    return Languages(names, pieces, p)


class _Memory:
    """Scores of words a worker has met, by hash."""

    def __init__(self, languages: Languages):
        self.languages = languages
        self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(languages.names)))

    def look_up(self, words: Words) -> np.ndarray:
        unique, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, unique), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == unique if len(self.hashes) else np.zeros(len(unique), bool)
        out = np.empty((len(unique), len(self.languages.names)))
        out[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        start, end = words.start[first[new]], words.end[first[new]]
        for block in blocks(end - start, out.shape[1]):
            some = new[block]
            lattice = Lattice.of(self.languages.pieces, words.data, start[block], end[block])
            out[some] = lattice.log_scores(self.languages.p)
        if len(new):
            if len(self.hashes) + len(new) > REMEMBERED:
                self.hashes, self.scores = unique, out
            else:
                hashes = np.concatenate([self.hashes, unique[new]])
                order = np.argsort(hashes, kind="stable")
                self.hashes, self.scores = hashes[order], np.concatenate([self.scores, out[new]])[order]
        return out[place]


def identify_languages(documents: DataFrame, languages: Languages, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language and its posterior probability, all languages alike beforehand.

    NULL texts and texts without a letter are ``und`` with score 0, as is
    everything if no language was learned; texts whose letters give no word
    have the first language by name, with an even score.  Ties go to the first
    by name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(shared.value)
        names = np.array([*memory.languages.names, UNKNOWN], dtype=object)
        for batch in batches:
            for rows, texts in slices(batch):
                lowered = _lowered(texts)
                words = _letter_words(lowered)
                best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
                if len(names) > 1:
                    total = np.concatenate([np.zeros((1, len(names) - 1)), np.cumsum(memory.look_up(words), axis=0)])
                    total = total[words.first[1:]] - total[words.first[:-1]]
                    ascii_letters = np.concatenate(([0], np.cumsum((words.data >= ord("a")) & (words.data <= ord("z")))))
                    ends = np.cumsum([len(t) + 1 for t in lowered])
                    some = ascii_letters[ends] > ascii_letters[ends - [len(t) + 1 for t in lowered]]
                    for d in np.flatnonzero(~some):
                        some[d] = any(c.isalpha() for c in lowered[d].decode())
                    likeliest = total.argmax(axis=1)
                    posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    best[some], score[some] = likeliest[some], posterior[some]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
                )

    picked = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(score, "doc_id bigint, lang_pred string, score double")


def predict_languages(documents: DataFrame, folds: int = 4, held_out: int = 2, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score per document; languages are learned outside the held-out fold only."""
    languages = fit_languages(documents, folds, held_out, doc_id=doc_id, text=text, **options)
    found = identify_languages(documents, languages, doc_id, text)
    return found.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")
