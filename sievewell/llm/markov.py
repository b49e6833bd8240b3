"""A hidden Markov language model, trained by Baum-Welch over all partitions.

A text is the sequence of its lower-cased words and one end.  A hidden state
gives a symbol, one of a fixed number of classes that words fall into by
hash; the end has a symbol to itself.  Within its class a word has the share
of its own count in the training texts, so that the vocabulary may grow as it
likes while the model that tasks need stays of one size:

    P(text) = sum over state sequences of prod A(s, s') B(s', class of word) * prod P(word | class)

Each round of Baum-Welch adds the expected counts of all training texts: a
task sums its own, Spark adds those of a class, and only the totals of the
classes (a fixed number) come to the driver.  Tasks' counts are summed as whole
numbers of 1/65536, so that the model hardly depends on how rows are dealt.

Texts are kept as blocks of numbered words, written once, and the training
texts as symbols besides.  What is counted and looked up are the different
words of blocks, not all tokens, and no task needs the whole vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewell.llm.sampling import fold
from sievewell.llm.store import stored
from sievewell.llm.words import LOWER, NOT_SPACE, slices

#: The end of a text among the words, none of which holds a blank.
END = b" "
#: Bytes of text in a block; a longer text is a block of its own.  The larger, the fewer rows words have: one for each block they are in.
BLOCK_BYTES = 16 << 20
#: Words of so many bytes or more have their CRC found one by one.
LONG_WORD = 24
#: Tokens whose states are held at once; of longer runs only the states at the bounds are kept, and the rest found anew.
SPAN = 1 << 19
#: Tokens of blocks from which texts of like length are put together.
TOGETHER = 1 << 24
#: Every how many steps the shares of states are made to add up to one.
EVERY = 2
#: Places whose moves or symbols are added up at once.
WINDOW = 1 << 18
#: Places turned at once.
PIECE = 1 << 11
#: Training tokens whose expected counts a task adds up before they are shuffled, unless there would be fewer tasks than cores.
TASK_TOKENS = 10_000_000
#: Expected counts are summed as whole numbers of this part.
UNITS = 1 << 16

SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_BLOCKS = (
    "block bigint, n bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary, "
    "words array<binary>, train array<bigint>, learn_symbols binary, learn_lengths binary"
)


@dataclass(frozen=True)
class Shape:
    """Size and training of a model.

    ``early_rounds`` of Baum-Welch, in which the states part, and ``rounds``
    after them all run over all training texts, however many there are.
    ``prior`` tokens dealt as in all texts are added to what each state gives.
    """

    states: int = 16
    symbols: int = 1 << 16
    rounds: int = 3
    early_rounds: int = 6
    prior: float = 8192.0
    stay: float = 0.9
    noise: float = 1.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``first`` (states), ``move`` (states, states) and ``give`` (states, symbols) as probabilities."""

    first: np.ndarray
    move: np.ndarray
    give: np.ndarray


@dataclass(frozen=True)
class Usage:
    """Training tokens and different words, of all symbols together and of each."""

    tokens: int
    words: int
    tokens_of: np.ndarray
    words_of: np.ndarray


# --- texts as blocks ----------------------------------------------------------------------


def split_words(texts: list[bytes | None]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of the texts in order, lower-cased, and how many each text has."""
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    data = LOWER[np.frombuffer(joined, dtype=np.uint8)]
    inside = NOT_SPACE[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    per_text = np.diff(np.searchsorted(start, ends), prepend=0)
    # Word bytes side by side are the values of a binary array as they stand.
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, per_text


def one_list(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def width(words: int) -> type:
    """The type that numbers so many words."""
    return np.uint16 if words <= 1 << 16 else np.int32


def symbol_of(word: bytes, symbols: int) -> int:
    return 0 if word == END else 1 + zlib.crc32(word) % (symbols - 1)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32(words: pa.BinaryArray) -> np.ndarray:
    """What ``zlib.crc32`` gives for each word, byte after byte of all words that have one; long words go there by themselves."""
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    lengths = np.diff(bounds)
    if not lengths.any():
        return np.zeros(len(words), dtype=np.uint32)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(words), dtype=np.uint32)
    long = int(np.searchsorted(-lengths[order], -LONG_WORD, side="right"))
    for k in order[:long].tolist():
        out[k] = zlib.crc32(data[bounds[k] : bounds[k + 1]])
    order = order[long:]
    at, live = bounds[order], np.searchsorted(-lengths[order], -np.arange(1, LONG_WORD), side="right")
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for j, n in enumerate(live[live > 0].tolist()):
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + j]) & 0xFF] ^ (crc[:n] >> 8)
    out[order] = ~crc
    return out


def to_blocks(documents: DataFrame, held_out: Column, shape: Shape, doc_id: str, text: str) -> DataFrame:
    """Documents as blocks; what is in a block depends on how Spark deals the rows, so blocks must be written before use.

    ``learn_symbols`` and ``learn_lengths`` are the training texts as symbols, which is all that the rounds of training read.
    """
    rows = documents.select(
        F.spark_partition_id().alias("part"), F.col(doc_id).cast("bigint").alias("doc_id"), held_out.alias("held"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            for part, texts in slices(batch, size=BLOCK_BYTES):
                words, per_text = split_words(texts)
                numbered = words.dictionary_encode()
                own = numbered.dictionary
                # The end of each text is behind its words, and numbered behind all of them.
                tokens = np.insert(numbered.indices.to_numpy(zero_copy_only=False), np.cumsum(per_text), len(own)).astype(width(len(own) + 1))
                lengths = per_text + 1
                held = np.asarray(part.column(2).to_numpy(zero_copy_only=False), dtype=bool)
                learned = tokens[~np.repeat(held, lengths)]
                train = np.bincount(learned, minlength=len(own) + 1)
                # As ``symbol_of`` has it.
                symbols = 1 + crc32(own).astype(np.int64) % (shape.symbols - 1)
                symbols = np.append(symbols, 0).astype(width(shape.symbols))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(part.column(0)[0].as_py() << 32) + made]), pa.array([len(tokens)], pa.int64()), one_list(part.column(1)),
                        one_list(part.column(2)), one_list(pa.array(lengths, pa.int32())), pa.array([tokens.tobytes()], pa.binary()),
                        one_list(pa.concat_arrays([own, pa.array([END], pa.binary())])), one_list(pa.array(train)),
                        pa.array([symbols[learned].tobytes()], pa.binary()), pa.array([lengths[~held].astype(np.int32).tobytes()], pa.binary()),
                    ],
                    names=[c.split()[0] for c in _BLOCKS.split(", ")],
                )
                made += 1

    return rows.mapInArrow(cut, _BLOCKS)


def vocabulary(blocks: DataFrame, symbols: int) -> DataFrame:
    """(block, place, symbol, c, leads) of every block's different words: c is a word's count in all training texts.

    ``leads`` is true once for each word.  A word has a row for each block
    that it is in, so that even the commonest word's rows are few beside all.
    """
    each = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("place", "w"))
    same = Window.partitionBy("word")
    counted = each.select("block", "place", F.col("w.words").alias("word"), F.col("w.train").alias("n")).select(
        "block", "place", "word", F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("leads")
    )
    # As ``symbol_of`` has it.
    symbol = F.when(F.col("word") == F.lit(END), 0).otherwise(F.crc32("word") % (symbols - 1) + 1).cast("int")
    return counted.select("block", "place", symbol.alias("symbol"), "c", "leads")


def usage(words: DataFrame, symbols: int) -> Usage:
    """Totals of a vocabulary: a row for each symbol at the most."""
    found = words.where("leads AND c > 0").groupBy("symbol").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow()
    tokens_of, words_of = np.zeros(symbols, dtype=np.int64), np.zeros(symbols, dtype=np.int64)
    place = found.column("symbol").to_numpy()
    tokens_of[place], words_of[place] = found.column("c").to_numpy(), found.column("v").to_numpy()
    return Usage(int(tokens_of.sum()), int(words_of.sum()), tokens_of, words_of)


# --- recursions -----------------------------------------------------------------------------


class Room:
    """Arrays that are used again and again, as fresh ones of such a size cost more time than what is done with them."""

    def __init__(self) -> None:
        self._kept: dict[str, np.ndarray] = {}

    def empty(self, name: str, shape: tuple[int, int], dtype: type) -> np.ndarray:
        """An array with anything in it; what the last one of that name held is lost."""
        size = shape[0] * shape[1]
        if name not in self._kept or len(self._kept[name]) < size or self._kept[name].dtype != dtype:
            self._kept[name] = np.empty(size, dtype=dtype)
        return self._kept[name][:size].reshape(shape)


@dataclass(frozen=True)
class Steps:
    """Sequences side by side, longest first: step t has the t-th symbols of the live[t] sequences that are so long.

    They are at places first[t] to first[t + 1] of ``symbol``; ``rank`` is the
    place of each sequence in that order.
    """

    symbol: np.ndarray
    live: np.ndarray
    first: np.ndarray
    rank: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray, starts: np.ndarray | None = None) -> Steps:
        """``lengths`` are at least one; a sequence begins at its place in ``starts``, else behind the one before it."""
        starts = np.cumsum(lengths) - lengths if starts is None else starts
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        live = np.searchsorted(-lengths[order], -np.arange(1, lengths.max(initial=0) + 1), side="right")
        first = np.concatenate(([0], np.cumsum(live)))
        place = np.arange(first[-1])
        place -= np.repeat(first[:-1], live)
        taken = starts[order][place]
        taken += np.repeat(np.arange(len(live)), live)
        return cls(symbols[taken], live, first, rank)

    def given(self, span: tuple[int, int], model: Model, room: Room) -> np.ndarray:
        """(places, states) of a span: how likely each state gives the symbol there."""
        symbol = self.symbol[self.first[span[0]] : self.first[span[1]]]
        out = room.empty("given", (len(symbol), len(model.give)), model.give.dtype)
        # All symbols are there, so that none is clipped.
        return np.take(np.ascontiguousarray(model.give.T), symbol, axis=0, out=out, mode="clip")

    def spans(self, most: int) -> list[tuple[int, int]]:
        """Runs of steps with no more than ``most`` symbols, of one step at least."""
        out, at = [], 0
        while at < len(self.live):
            to = max(at + 1, int(np.searchsorted(self.first, self.first[at] + most, side="right")) - 1)
            out.append((at, to))
            at = to
        return out


def forward(steps: Steps, span: tuple[int, int], given: np.ndarray, model: Model, before: np.ndarray | None, room: Room) -> tuple[np.ndarray, list[np.ndarray]]:
    """Scaled forward recursion over a span: state shares (places, states) after each symbol, and what they were divided by.

    ``given`` are the probabilities of each place's symbol, ``before`` the
    shares at the start, None at that of the sequences.  There are divisors
    (sequences, 1) for every ``EVERY``-th step from that of the sequences'
    start; their product and the sum of its last shares make the probability
    of a sequence.
    """
    shares, divisors, at = room.empty("shares", given.shape, given.dtype), [], 0
    ones = np.ones((given.shape[1], 1), dtype=given.dtype)
    for step, n in enumerate(steps.live[span[0] : span[1]].tolist(), span[0]):
        now = shares[at : at + n]
        if before is None:
            np.multiply(given[:n], model.first, out=now)
        else:
            # Arrays are small here, and ``dot`` takes less time than ``matmul`` before it begins.
            np.dot(before[:n], model.move, out=now)
            now *= given[at : at + n]
        if step % EVERY == 0:
            divisors.append(np.dot(now, ones))
            now /= divisors[-1]
        before, at = now, at + n
    return shares, divisors


def ends(live: np.ndarray, onward: int) -> tuple[np.ndarray, np.ndarray]:
    """Where sequences end, as places counted from the first of the steps and as ranks; ``onward`` go on after the last step."""
    later = np.append(live[1:], onward)
    ended = live - later
    rank = np.arange(ended.sum()) + np.repeat(later - np.cumsum(ended) + ended, ended)
    return rank + np.repeat(np.cumsum(live) - live, ended), rank


def log10_probabilities(steps: Steps, model: Model, room: Room | None = None) -> np.ndarray:
    """Of each sequence, in the order given to ``Steps.of``."""
    total, before, room = np.zeros(len(steps.rank)), None, room or Room()
    for span in steps.spans(SPAN // 4):
        live = steps.live[span[0] : span[1]]
        shares, divisors = forward(steps, span, steps.given(span, model, room), model, before, room)
        for divisor in divisors:
            total[: len(divisor)] += np.log10(divisor[:, 0])
        place, rank = ends(live, 0 if span[1] == len(steps.live) else steps.live[span[1]])
        total[rank] += np.log10(shares[place].sum(axis=1))
        before = shares[len(shares) - live[-1] :].copy()
    return total[steps.rank]


@dataclass
class Expected:
    """Expected counts: of first states, moves and given symbols."""

    first: np.ndarray
    move: np.ndarray
    give: np.ndarray

    @classmethod
    def none(cls, symbols: int, states: int) -> Expected:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((states, symbols)))


def expect(steps: Steps, model: Model, out: Expected | None = None, room: Room | None = None) -> Expected:
    """Baum-Welch: expected counts of all sequences, added to ``out``; they depend on the ratios within each symbol's ``give`` only.

    Beyond ``SPAN`` tokens only the states at the bounds of spans are kept
    on the way forward; each span's are found again on the way back.
    """
    states, symbols = model.give.shape
    out, room = Expected.none(symbols, states) if out is None else out, room or Room()
    spans, starts, before = steps.spans(SPAN), [], None
    for k, span in enumerate(spans):
        starts.append(before)
        if k + 1 < len(spans):
            shares, _ = forward(steps, span, steps.given(span, model, room), model, before, room)
            before = shares[len(shares) - steps.live[span[1] - 1] :].copy()
    after = np.zeros((0, states), dtype=model.give.dtype)
    onto = np.ascontiguousarray(model.move.T)
    for span, before in zip(reversed(spans), reversed(starts)):
        at, to = steps.first[span[0]], steps.first[span[1]]
        symbol, live = steps.symbol[at:to], steps.live[span[0] : span[1]]
        later = steps.given(span, model, room)
        shares, divisors = forward(steps, span, later, model, before, room)
        # ``back`` is how likely all behind a symbol is given the state, scaled so that its product with the shares adds up to one;
        # ``later`` becomes the same with the symbol itself, given the state before it has moved.
        back = room.empty("back", later.shape, later.dtype)
        place, _ = ends(live, len(after))
        back[place] = 1 / shares[place].sum(axis=1, keepdims=True)
        onward = after
        for step in range(span[1] - 1, span[0] - 1, -1):
            here, n = steps.first[step] - at, steps.live[step]
            np.dot(onward, onto, out=back[here : here + len(onward)])
            onward = later[here : here + n]
            onward *= back[here : here + n]
            if step % EVERY == 0:
                onward /= divisors.pop()
        # Moves within the span, then those out of it. As long as no sequence ends, all come from equally far before.
        moved = np.zeros((states, states))
        runs = np.append(np.flatnonzero(np.diff(live[:-1], prepend=0)) + 1, len(live))
        bounds = steps.first[span[0] + runs] - at
        for start, end, far in zip(bounds.tolist(), bounds[1:].tolist(), live[runs[:-1] - 1].tolist()):
            for k in range(start, end, WINDOW):
                some = slice(k, min(k + WINDOW, end))
                moved += shares[some.start - far : some.stop - far].T @ later[some]
        last = to - at - live[-1]
        moved += shares[last : last + len(after)].T @ after
        out.move += model.move * moved
        for k in range(0, to - at, WINDOW):
            _add_up(out.give, symbol[k : k + WINDOW].astype(np.int64), shares[k : k + WINDOW], back[k : k + WINDOW], room)
        if span[0] == 0:
            out.first += (shares[: live[0]] * back[: live[0]]).sum(axis=0, dtype=np.float64)
        after = later[: live[0]].copy()
    return out


def _add_up(total: np.ndarray, symbol: np.ndarray, shares: np.ndarray, back: np.ndarray, room: Room) -> None:
    """Add the products of ``shares`` and ``back`` (places, states) of each symbol to ``total`` (states, symbols)."""
    by_state = room.empty("by_state", shares.shape[::-1], np.float64)
    # So narrow a table is turned fastest by pieces that stay in the processor's cache.
    for k in range(0, len(shares), PIECE):
        by_state[:, k : k + PIECE] = (shares[k : k + PIECE] * back[k : k + PIECE]).T
    for s, weights in enumerate(by_state):
        total[s] += np.bincount(symbol, weights=weights, minlength=total.shape[1])


# --- training -------------------------------------------------------------------------------


def beginning(shape: Shape, used: Usage) -> tuple[Model, np.ndarray]:
    """States that all give symbols as the texts do, but for a fixed disturbance that lets them part; the shares of symbols."""
    share = (used.tokens_of + 1) / (used.tokens + shape.symbols)
    give = share * np.exp(shape.noise * np.random.default_rng(shape.seed).standard_normal((shape.states, shape.symbols)))
    move = np.full((shape.states, shape.states), (1 - shape.stay) / max(shape.states - 1, 1))
    np.fill_diagonal(move, shape.stay if shape.states > 1 else 1.0)
    return Model(np.full(shape.states, 1 / shape.states), move, give / give.sum(axis=1, keepdims=True)), share


def improved(counts: Expected, share: np.ndarray, prior: float) -> Model:
    """The model that makes such counts likeliest, with one more of each first state and move and ``prior`` symbols as ``share`` deals them."""
    first, move, give = counts.first + 1, counts.move + 1, counts.give + prior * share
    return Model(first / first.sum(), move / move.sum(axis=1, keepdims=True), give / give.sum(axis=1, keepdims=True))


def alike(lengths: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places of the lengths, those of like ones together, in groups of no more than ``most`` altogether or of one."""
    order = np.argsort(-lengths, kind="stable")
    total, at = np.cumsum(lengths[order]), 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(total, total[at] - lengths[order[at]] + most, side="right")))
        yield order[at:to]
        at = to


def gather(blocks: DataFrame, model: Model) -> Expected:
    """Expected counts of all training texts of the blocks, added up over all partitions."""
    states, symbols = model.give.shape
    # The ratios of what states give are enough; up to one they cannot become too small within the steps between two divisions.
    give = np.asfortranarray(model.give / np.maximum(model.give.max(axis=0), np.finfo(np.float64).tiny), dtype=np.float32)
    shared = blocks.sparkSession.sparkContext.broadcast(Model(model.first.astype(np.float32), model.move.astype(np.float32), give))
    names = [f"s{k}" for k in range(states)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = Expected.none(symbols, states), Room()

        def add(texts: list[tuple[np.ndarray, np.ndarray]]) -> None:
            """Texts of like length go through the recursions together, so that there are few steps and many texts in each."""
            symbol, lengths = (np.concatenate(x) for x in zip(*texts))
            starts = np.cumsum(lengths) - lengths
            for some in alike(lengths, SPAN):
                expect(Steps.of(symbol, lengths[some], starts[some]), shared.value, total, room)

        waiting, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                symbol = np.frombuffer(batch.column(0)[row].as_py(), dtype=width(symbols))
                waiting.append((symbol, np.frombuffer(batch.column(1)[row].as_py(), dtype=np.int32).astype(np.int64)))
                size += len(symbol)
                if size >= TOGETHER:
                    add(waiting)
                    waiting, size = [], 0
        if waiting:
            add(waiting)
        # Columns: symbols, then the states moved to, then the first states.
        whole = np.rint(np.hstack([total.give, total.move, total.first[:, None]]) * UNITS).astype(np.int64)
        some = np.flatnonzero(whole.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(whole[k, some]) for k in range(states)]], names=["place", *names])

    parts = blocks.select("learn_symbols", "learn_lengths").mapInArrow(count, "place int, " + ", ".join(f"{c} bigint" for c in names))
    added = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    shared.unpersist()
    total = np.zeros((states, symbols + states + 1))
    if added.num_rows:
        total[:, added.column("place").to_numpy()] = np.stack([added.column(c).to_numpy() for c in names]) / UNITS
    return Expected(total[:, -1], total[:, symbols:-1], total[:, :symbols])


def fit(blocks: DataFrame, used: Usage, shape: Shape) -> Model:
    """Baum-Welch over written blocks, all of them in every round."""
    model, share = beginning(shape, used)
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-used.tokens // TASK_TOKENS))
    fewer = blocks.coalesce(tasks)
    for _ in range(shape.early_rounds + shape.rounds):
        model = improved(gather(fewer, model), share, shape.prior)
    return model


# --- scores ---------------------------------------------------------------------------------


def score(blocks: DataFrame, words: DataFrame, used: Usage, model: Model) -> DataFrame:
    """Every document of the blocks, scored whole; a block and its different words meet in one task."""
    shared = blocks.sparkSession.sparkContext.broadcast((Model(model.first, model.move, np.asfortranarray(model.give)), used))
    room = Room()

    def measure(words: pa.Table, rows: pa.Table) -> pa.Table:
        model, used = shared.value
        order = np.argsort(words.column("place").to_numpy())
        c, symbols = (words.column(name).to_numpy()[order] for name in ("c", "symbol"))
        ids, held, lengths = (rows.column(name).chunk(0)[0].values for name in ("doc_ids", "held", "lengths"))
        lengths = lengths.to_numpy().astype(np.int64)
        tokens = np.frombuffer(rows.column("tokens")[0].as_py(), dtype=width(len(c)))
        # Of different words, then of each token.
        plain = np.log10((c + 1) / (used.tokens + used.words + 1))
        within = np.log10((c + 1) / (used.tokens_of[symbols] + used.words_of[symbols] + 1))
        at = np.cumsum(lengths) - lengths
        hidden = log10_probabilities(Steps.of(symbols[tokens], lengths), model, room)
        return pa.Table.from_arrays(
            [
                ids, held, pa.array(lengths), pa.array(np.add.reduceat((c > 0).astype(np.int64)[tokens], at)),
                pa.array(np.full(len(lengths), used.tokens, dtype=np.int64)),
                pa.array(np.add.reduceat(plain[tokens], at)), pa.array(hidden + np.add.reduceat(within[tokens], at)),
            ],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )

    texts = blocks.select("block", "doc_ids", "held", "lengths", "tokens")
    return words.select("block", "place", "symbol", "c").groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(measure, SCHEMA)


def score_texts(documents: DataFrame, shape: Shape = Shape(), folds: int = 7, held_out: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, as in ``SCHEMA``: scores by single words (``base_score``) and by the hidden Markov model.

    Learns from the documents whose fold is not ``held_out``.  A NULL text is
    an empty one and has the end alone; a NULL id is in the fold of the empty
    string; repeated rows each count and come out alike; other columns are
    not looked at.  Without a training text all tokens are alike.
    """
    blocks = stored(to_blocks(documents, fold(F.col(doc_id).cast("bigint"), folds) == held_out, shape, doc_id, text), "markov-blocks", compression="zstd")
    words = stored(vocabulary(blocks, shape.symbols), "markov-words", compression="zstd")
    used = usage(words, shape.symbols)
    return score(blocks, words, used, fit(blocks, used, shape))
