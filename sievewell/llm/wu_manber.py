"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are all windows of 13 consecutive words of benchmark items (an item
of fewer words is one window).  The search looks at two-word blocks: a shift
table says how many words may be skipped because no pattern has that block
near its end; where the shift is zero, a bucket of the block's hash names the
patterns to try, and bytes are compared to confirm.  Texts are cut into lanes
that numpy advances together, each by its own shift.

A benchmark too large for one search is searched for in parts, one after the
other; each part gives the ranges it hits and its items for each text, and
these are united before anything is counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.store import stored
from sievewell.llm.words import ALPHANUMERIC, Words, cut, mix, slices
from sievewell.plans.skew import salted_lookup

WINDOW = 13
LANE = 256
#: Bytes of benchmark text (and 16 for each item) that one search may hold; checked before they are collected and broadcast.
#: Only an item that is larger by itself is searched for nevertheless, alone.
MOST_BENCHMARK_BYTES = 16 << 20
#: Buckets of items for each full part, by hash; parts are made of whole buckets.
BUCKETS_A_PART = 1024
#: Most digests of contaminated texts that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000

SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _block(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (1 or 2) words that end at each position."""
    last = hashes[at]
    return last if size == 1 else mix(last * np.uint64(3) + hashes[at - 1])


@dataclass
class _SameLength:
    """Tables for the patterns of one length; a pattern is the place of its last word among the benchmark's words."""

    length: int
    block: int
    shift: np.ndarray
    keys: np.ndarray
    ends: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray, ends: np.ndarray, length: int) -> _SameLength:
        block = min(2, length)
        mask_bits = max(12, int(np.ceil(np.log2(max(len(ends), 1) * 4 + 1))) + 3)
        longest = length - block + 1
        shift = np.full(1 << mask_bits, longest, dtype=np.int16)
        for back in reversed(range(longest)):
            slot = (_block(hashes, ends - back, block) & np.uint64(len(shift) - 1)).astype(np.int64)
            shift[slot] = np.minimum(shift[slot], back)
        keys = cls._key(hashes, ends, length, block)
        order = np.argsort(keys, kind="stable")
        return cls(length, block, shift, keys[order], ends[order])

    @staticmethod
    def _key(hashes: np.ndarray, ends: np.ndarray, length: int, block: int) -> np.ndarray:
        """Bucket of a pattern: its last block together with its first."""
        return mix(_block(hashes, ends, block) + _block(hashes, ends - length + block, block) * np.uint64(5))

    def positions(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Ends of places where the shift table rules nothing out."""
        n = np.diff(first)
        room = np.maximum(n - self.length + 1, 0)
        lanes = -(-room // LANE)
        doc = np.repeat(np.arange(len(n)), lanes)
        at = first[doc] + self.length - 1 + LANE * (np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        stop = np.minimum(at + LANE, first[doc + 1])
        found = []
        mask = np.uint64(len(self.shift) - 1)
        while len(at):
            step = self.shift[(_block(hashes, at, self.block) & mask).astype(np.int64)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def candidates(self, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in the text, place in the benchmark) from equal buckets."""
        keys = self._key(hashes, ends, self.length, self.block)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        count = high - low
        text = np.repeat(ends, count)
        pattern = self.ends[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
        return text, pattern


def _distinct(hashes: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The ends in an order that brings equal windows together, and a number for each different window."""
    whole = np.zeros(len(ends), dtype=np.uint64)
    for back in range(length):
        whole = mix(whole + hashes[ends - back] * np.uint64(2 * back + 3))
    ends = ends[np.argsort(whole, kind="stable")]
    whole.sort()
    new = whole[1:] != whole[:-1]
    for back in range(length):
        new |= hashes[ends[1:] - back] != hashes[ends[:-1] - back]
    return ends, np.concatenate(([0], np.cumsum(new)))


class Patterns:
    """All different windows of the benchmark's items, each with the items that hold it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        self.words = cut([text for _, text in items], ALPHANUMERIC)
        self.hashes = self.words.hashes()
        self.item = self.words.doc
        first = self.words.first
        n = np.diff(first)
        ends: dict[int, list[np.ndarray]] = {}
        for d in np.flatnonzero(n):
            length = min(int(n[d]), window)
            ends.setdefault(length, []).append(np.arange(first[d] + length - 1, first[d + 1]))
        self.tables, self.window_of, owners = [], np.full(len(self.hashes), -1, dtype=np.int64), [np.zeros((0, 2), dtype=np.int64)]
        self.count = 0
        for length, e in sorted(ends.items()):
            place, window_id = _distinct(self.hashes, np.concatenate(e), length)
            _, kept = np.unique(window_id, return_index=True)
            self.window_of[place[kept]] = np.arange(len(kept)) + self.count
            owners.append(np.unique(np.stack([window_id + self.count, self.item[place]], axis=1), axis=0))
            self.tables.append(_SameLength.build(self.hashes, np.sort(place[kept]), length))
            self.count += len(kept)
        owned = np.concatenate(owners)
        self.owners, self.owned_from = owned[:, 1], np.searchsorted(owned[:, 0], np.arange(self.count + 1))

    def items_of(self, window: int) -> np.ndarray:
        return self.owners[self.owned_from[window] : self.owned_from[window + 1]]

    def occurrences(self, text: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Confirmed (end in the text, length, window) of every different window."""
        hashes = text.hashes()
        out = [(np.zeros(0, np.int64),) * 3]
        for table in self.tables:
            at, pattern = table.candidates(hashes, table.positions(hashes, text.first))
            for back in range(table.length):
                same = hashes[at - back] == self.hashes[pattern - back]
                at, pattern = at[same], pattern[same]
            # Equal hashes are equal words for all practical purposes; the bytes decide.
            sure = np.fromiter(
                (self._spelled(text, a, table.length) == self._spelled(self.words, p, table.length) for a, p in zip(at, pattern)),
                dtype=bool, count=len(at),
            )
            at, pattern = at[sure], pattern[sure]
            out.append((at, np.full(len(at), table.length), self.window_of[pattern]))
        at, length, window = (np.concatenate(x) for x in zip(*out))
        return at, length, window

    @staticmethod
    def _spelled(words: Words, end: int, length: int) -> list[bytes]:
        return [words.data[words.start[i] : words.end[i]].tobytes() for i in range(end - length + 1, end + 1)]


def _marked(patterns: Patterns, words: Words) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Where windows end; +1 and -1 where they begin and are over; the items' names of each text."""
    at, length, window = patterns.occurrences(words)
    edge = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(edge, at - length + 1, 1)
    np.add.at(edge, at + 1, -1)
    doc = np.searchsorted(words.first, at, side="right") - 1
    items: list[set[str]] = [set() for _ in words.first[1:]]
    met = np.unique(np.stack([doc, window], axis=1), axis=0)
    for d, w in met.tolist():
        items[d].update(patterns.names[i] for i in patterns.items_of(w))
    return at, edge, [sorted(s) for s in items]


def _judged(patterns: Patterns, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    words = cut(texts, ALPHANUMERIC)
    _, edge, items = _marked(patterns, words)
    hit = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
    return np.diff(words.first), np.diff(hit[words.first]), items


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    picked = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("string").alias("t"))
    return picked.where("t is not null").withColumn("bytes", F.octet_length("t") + F.lit(16).cast("bigint"))


def _searcher(items: DataFrame, window: int):
    """A function for tasks that gives the patterns of ``items``, which are broadcast."""
    held = items.sparkSession.sparkContext.broadcast([(r.i, r.t.encode()) for r in items.select("i", "t").collect()])
    return lambda: Patterns(held.value, window)


def _parts(items: DataFrame) -> list[DataFrame]:
    """``items`` as one table, or as several that are each small enough for a search."""
    size = items.agg(F.sum("bytes")).first()[0] or 0
    if size <= MOST_BENCHMARK_BYTES:
        return [items]
    buckets = BUCKETS_A_PART * -(-size // MOST_BENCHMARK_BYTES)
    dealt = stored(items.distinct().withColumn("bucket", F.pmod(F.xxhash64("i", "t"), F.lit(buckets))), "items")
    sizes = sorted((r.bucket, r.n) for r in dealt.groupBy("bucket").agg(F.sum("bytes").alias("n")).collect())
    parts, low, full = [], sizes[0][0], 0
    for bucket, n in sizes:
        if full and full + n > MOST_BENCHMARK_BYTES:
            parts.append((low, bucket))
            low, full = bucket, 0
        full += n
    parts.append((low, buckets))
    return [dealt.where((F.col("bucket") >= x) & (F.col("bucket") < y)) for x, y in parts]


def _digest(text: str):
    return F.sha2(F.col(text).cast("string").cast("binary"), 256)


def _hits(documents: DataFrame, parts: list[DataFrame], text: str, window: int) -> DataFrame:
    """(digest, n_words, n_hit, names) of each different text that any part of the benchmark hits."""
    texts = documents.select(_digest(text).alias("digest"), F.col(text).cast("string").alias("text")).where("text is not null")
    every: DataFrame | None = None
    for part in parts:
        build = _searcher(part, window)

        def scan(batches: Iterator[pa.RecordBatch], build=build) -> Iterator[pa.RecordBatch]:
            patterns = build()
            for batch in batches:
                for rows, found in slices(batch):
                    words = cut(found, ALPHANUMERIC)
                    at, edge, items = _marked(patterns, words)
                    inside = np.cumsum(edge[:-1]) > 0
                    for d in np.unique(np.searchsorted(words.first, at, side="right") - 1):
                        here = inside[words.first[d] : words.first[d + 1]]
                        turns = np.flatnonzero(np.diff(here.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
                        ranges = [{"a": int(x), "b": int(y)} for x, y in zip(turns[::2], turns[1::2])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows.column(0).slice(d, 1), pa.array([len(here)], pa.int64()),
                                pa.array([ranges], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                                pa.array([items[d]], pa.list_(pa.string())),
                            ],
                            names=["digest", "n_words", "ranges", "names"],
                        )

        found = texts.mapInArrow(scan, "digest string, n_words bigint, ranges array<struct<a:bigint,b:bigint>>, names array<string>")
        found = stored(found.dropDuplicates(["digest"]), "hits")
        every = found if every is None else every.union(found)
    whole = every.groupBy("digest").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
    )
    none = F.struct(F.lit(0).cast("bigint").alias("to"), F.lit(0).cast("bigint").alias("n"))

    def longer(so_far, x):
        new = F.greatest(F.lit(0).cast("bigint"), x["b"] - F.greatest(x["a"], so_far["to"]))
        return F.struct(F.greatest(so_far["to"], x["b"]).alias("to"), (so_far["n"] + new).alias("n"))

    return whole.select("digest", "n_words", F.aggregate("ranges", none, longer)["n"].alias("n_hit"), "names")


def _found_in_parts(documents: DataFrame, parts: list[DataFrame], window: int, share: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                n = np.diff(cut(texts, ALPHANUMERIC).first)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(n)], names=["doc_id", "digest", "n_words"])

    hits = _hits(documents, parts, "text", window).drop("n_words")
    counted = documents.select("doc_id", _digest("text").alias("digest"), "text").mapInArrow(count, "doc_id bigint, digest string, n_words bigint")
    joined = salted_lookup(counted, hits, ["digest"], ["doc_id"], salts=8, how="left")
    n_hit, names = F.coalesce("n_hit", F.lit(0).cast("bigint")), F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = 20,
) -> DataFrame:
    """One row per document: words, words inside windows of the benchmark, and which items those are from.

    A document is contaminated if at least one in ``share`` of its words is
    hit.  NULL and wordless texts have no words and no hits; NULL and wordless
    items have no windows; an item id that repeats counts once, a NULL id is
    written as an empty string.  Repeated documents give repeated rows, and
    other columns are left out.  No hit: the digest of the empty string.
    """
    picked = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = _parts(_items(benchmark, item_id, item_text))
    if len(parts) > 1:
        return _found_in_parts(picked, parts, window, share)
    build = _searcher(parts[0], window)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = build()
        for batch in batches:
            for rows, texts in slices(batch):
                n, hit, found = _judged(patterns, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), pa.array(n), pa.array(hit), pa.array([len(f) for f in found], pa.int64()),
                        pa.array([hashlib.sha256(",".join(f).encode()).hexdigest() for f in found]),
                        pa.array(_contaminated(n, hit, share)),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return picked.mapInArrow(scan, SCHEMA)


def _contaminated(n: np.ndarray, hit: np.ndarray, share: int) -> np.ndarray:
    return (hit > 0) & (share * hit >= n)


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, share: int = 20,
) -> DataFrame:
    """``documents`` without the contaminated ones; all columns stay, and nothing is shuffled if one search holds the benchmark."""
    parts = _parts(_items(benchmark, item_id, item_text))
    if len(parts) > 1:
        hits = _hits(documents, parts, text, window)
        bad = stored(hits.where((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).select(F.col("digest").alias("__digest")), "contaminated")
        if bad.count() <= MOST_BROADCAST:
            bad = F.broadcast(bad)
        return documents.join(bad, _digest(text) == F.col("__digest"), "left_anti")
    build = _searcher(parts[0], window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = build()
        for batch in batches:
            for rows, texts in slices(batch, text):
                n, hit, _ = _judged(patterns, texts)
                yield rows.filter(pa.array(~_contaminated(n, hit, share)))

    return documents.mapInArrow(keep, documents.schema)
