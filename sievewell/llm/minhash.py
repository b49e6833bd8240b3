"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A first permutation scatters the shingles over a ring; a second one, a fixed
table of ranks around the ring, is shifted by one place for every coordinate.
The coordinates of one shingle are therefore neighbours in the table, and a
signature is the minimum over one slice of the table per shingle.

Texts with equal shingle sets form one class.  Classes meet in buckets of equal
bands; buckets are cut into blocks of bounded size, and a task sees one pair of
blocks.  There a class asks the likeliest partner among those of other
components; full sets are compared, components joined, and
buckets that still hold several components asked again for as long as that
joins any, and at last for *every* pair between different components that could
reach the threshold.  What could is decided by bitmaps of the sets, which bound
the number of shared shingles from above and estimate nothing.  So groups
of thousands of copies cost a few comparisons per text, and no two classes that
meet in a bucket are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.graph import components
from sievewell.llm.store import stored
from sievewell.llm.words import NOT_SPACE, cut, mix, runs, slices
from sievewell.plans.skew import salted_lookup

RING = 1 << 20
BAND_ROWS = 5
BANDS = 28
COORDINATES = BAND_ROWS * BANDS
#: Bits of a set's bitmap.  Longer sets fill it, and then it rules out less.
MARKS = 2048
#: Classes in a block; a task compares two blocks at a time.
BLOCK = 1024
#: Most ids that are broadcast to pick texts; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000

_SKETCH = "key bigint, doc_id bigint, node bigint, n_shingles bigint, bands array<bigint>, marks binary, tags binary"


@dataclass(frozen=True)
class Likeness:
    """Words per shingle, and the least percentage of shared shingles for a link."""

    words: int = 5
    percent: int = 80


def _ring() -> np.ndarray:
    ranks = np.random.default_rng(20240607).permutation(RING).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:COORDINATES]]), COORDINATES)


_tables: dict[str, np.ndarray] = {}


def signature(shingles: np.ndarray) -> np.ndarray:
    """The coordinates of one non-empty set of shingle hashes."""
    if "ring" not in _tables:
        _tables["ring"] = _ring()
    place = (mix(shingles ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(RING - 1)).astype(np.int64)
    out = np.full(COORDINATES, RING, dtype=np.int32)
    for at in range(0, len(place), 4096):
        np.minimum(out, _tables["ring"][place[at : at + 4096]].min(axis=0), out=out)
    return out


def _marks(shingles: np.ndarray) -> bytes:
    """One bit for each value that a hash of the shingles takes."""
    bits = np.zeros(MARKS, dtype=bool)
    bits[(mix(shingles ^ np.uint64(0x8EBC6AF09C88C6E3)) & np.uint64(MARKS - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_shared(n: np.ndarray, marks: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """No fewer than the shingles that each of ``left`` shares with each of ``right``.

    A bit that only one set has is a shingle that the other lacks, so at most
    its size less the number of such bits are shared.
    """
    spare = n - np.bitwise_count(marks).sum(axis=1, dtype=np.int64)
    out = np.minimum(spare[left][:, None], spare[right])
    there = marks[right]
    for i, x in enumerate(left):
        out[i] += np.bitwise_count(marks[x] & there).sum(axis=1, dtype=np.int64)
    return out


def _sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    words = cut(texts, NOT_SPACE)
    hashes, bounds = runs(words.hashes(), words.first, width)
    return [np.unique(hashes[bounds[d] : bounds[d + 1]]) for d in range(len(texts))]


def _node(shingles: np.ndarray) -> int:
    """A hash of a whole set; equal sets are one class."""
    folded = np.array([shingles.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(shingles)), len(shingles)], dtype=np.uint64)
    odd = np.array([3, 7, 11], dtype=np.uint64)
    return int(mix((mix(folded) * odd).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).select(
        F.coalesce("doc_id", F.xxhash64("text")).alias("key"), "doc_id", "text"
    )


def _sketches(documents: DataFrame, like: Likeness) -> DataFrame:
    numbers = np.arange(1, BANDS + 1, dtype=np.uint64)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                sets = _sets(texts, like.words)
                signed = [signature(s).astype(np.uint64) if len(s) else None for s in sets]
                bands, tags = [], []
                for s in signed:
                    if s is None:
                        bands.append(None)
                        tags.append(None)
                        continue
                    key = numbers
                    for part in s.reshape(BANDS, BAND_ROWS).T:
                        key = mix(key * np.uint64(31) + part)
                    bands.append(key.astype(np.int64))
                    tags.append(key.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), rows.column(1),
                        pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())), pa.array([_marks(s) if len(s) else None for s in sets], pa.binary()), pa.array(tags, pa.binary()),
                    ],
                    names=["key", "doc_id", "node", "n_shingles", "bands", "marks", "tags"],
                )

    return documents.mapInArrow(sketch, _SKETCH)


def _shingle_sets(documents: DataFrame, keys: DataFrame, like: Likeness) -> DataFrame:
    """(node, shingles) of the texts whose key is in ``keys``."""
    if keys.count() <= MOST_BROADCAST:
        keys = F.broadcast(keys)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch):
                found = [s for s in _sets(texts, like.words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(s) for s in found], pa.int64()), pa.array([s.astype(np.int64) for s in found], pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    return documents.join(keys, "key", "left_semi").select("text").mapInArrow(sets, "node bigint, shingles array<bigint>")


def _partners(members: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Pairs (a, b) of different components worth comparing, from blocks of buckets.

    ``members``: bucket, blocks (how many the bucket has), node, component,
    n_shingles, marks, tags.  A pair that meets in several buckets is
    given by the one of its first common band only.
    """
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    numbered = members.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = numbered.select("*", other.alias("other")).select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
        "node", "component", "n_shingles", "marks", "tags",
    )
    dealt = paired.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")

    def compare(group: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if group["low"][0] == group["high"][0]:
            left = right = np.arange(len(group["node"]))
        else:
            left = np.flatnonzero(group["own"] == group["low"][0])
            right = np.flatnonzero(group["own"] != group["low"][0])
        if not len(left) or not len(right):
            return left[:0], right[:0]
        n, component = group["n_shingles"], group["component"]
        shared = most_shared(n, group["marks"], left, right)
        either = n[left][:, None] + n[right] - shared
        possible = (component[left][:, None] != component[right]) & (100 * shared >= percent * either)
        if not best_only:
            i, j = np.nonzero(possible)
            return first_meetings(group, left[i], right[j])
        alike = np.where(possible, shared / either, 0)
        i, j = np.arange(len(left)), alike.argmax(axis=1)
        good = possible[i, j]
        pairs = [(left[i[good]], right[j[good]])]
        if left is not right:
            j, i = np.arange(len(right)), alike.argmax(axis=0)
            good = possible[i, j]
            pairs.append((left[i[good]], right[j[good]]))
        return first_meetings(group, *(np.concatenate(x) for x in zip(*pairs)))

    def first_meetings(group: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        here = group["bucket"][0].astype(np.uint64)
        tags = group["tags"]
        good = np.zeros(len(i), dtype=bool)
        for at in range(0, len(i), 1 << 16):
            x, y = tags[i[at : at + (1 << 16)]], tags[j[at : at + (1 << 16)]]
            first = (x == y).argmax(axis=1)
            good[at : at + (1 << 16)] = x[np.arange(len(x)), first] == here
        return i[good], j[good]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None

        def paired_in(columns: dict[str, np.ndarray], last: bool):
            new = np.zeros(len(columns["node"]), dtype=bool)
            new[:1] = True
            for c in ("bucket", "low", "high"):
                new[1:] |= columns[c][1:] != columns[c][:-1]
            starts = np.append(np.flatnonzero(new), len(new))
            found = []
            whole = len(starts) - 1 if last else len(starts) - 2
            for g in range(whole):
                part = slice(starts[g], starts[g + 1])
                if part.stop - part.start > 1:
                    group = {k: v[part] for k, v in columns.items()}
                    i, j = compare(group)
                    if len(i):
                        found.append((group["node"][i], group["node"][j]))
            kept_from = starts[max(whole, 0)]
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            out = pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            return out, {k: v[kept_from:] for k, v in columns.items()}

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "low", "high", "own", "node", "component", "n_shingles")}
            columns["marks"] = np.frombuffer(b"".join(batch.column("marks").to_pylist()), dtype=np.uint64).reshape(-1, MARKS // 64)
            columns["tags"] = np.frombuffer(b"".join(batch.column("tags").to_pylist()), dtype=np.uint64).reshape(-1, BANDS)
            if rest is not None:
                columns = {k: np.concatenate([rest[k], v]) for k, v in columns.items()}
            out, rest = paired_in(columns, last=False)
            yield out
        if rest is not None:
            yield paired_in(rest, last=True)[0]

    return dealt.mapInArrow(groups, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets share enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b")
    counted = joined.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    return counted.where(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("sum") - F.col("both"))).select("a", "b")


def _joined(documents: DataFrame, like: Likeness, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The sketches of all documents, and (node, component) of linked classes."""
    keyed = _keyed(documents, doc_id, text)
    sketched = stored(_sketches(keyed, like), "sketches")
    classes = stored(
        sketched.where("node is not null").select("node", "key", "n_shingles", "bands", "marks", "tags").dropDuplicates(["node"]), "classes"
    )
    placed = classes.select(F.explode("bands").alias("bucket"), "node")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("bigint").alias("blocks")
    placed = stored(placed.join(shared.select("bucket", blocks), "bucket"), "buckets")
    facts = stored(
        classes.join(placed.select("node").distinct(), "node", "left_semi").select("node", "key", "n_shingles", "marks", "tags"), "facts"
    )
    joined: DataFrame | None = None
    sets: DataFrame | None = None
    best_only = True
    while True:
        if joined is None:
            known = placed.withColumn("component", F.col("node"))
        else:
            known = placed.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
            mixed = known.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
            known = stored(known.join(mixed.select("bucket"), "bucket", "left_semi"), "mixed")
            placed = known.select("bucket", "node", "blocks")
        # What is compared is joined last, so that only buckets still mixed carry it.
        members = known.join(facts.drop("key"), "node")
        pairs = stored(_partners(members, like.percent, best_only), "pairs")
        if sets is None:
            asked = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b"))).distinct()
            sets = stored(_shingle_sets(keyed, facts.join(asked, "node", "left_semi").select("key"), like), "sets")
        links = stored(_verified(pairs, sets, like.percent), "verified")
        merged = links.limit(1).count() > 0
        if joined is None or merged:
            old = links.limit(0) if joined is None else joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
            joined = components(links.union(old))
        if not best_only:
            break
        # While asking the likeliest partners joins components, ask again: every round at least halves those that can be joined.
        best_only = merged
    return sketched, joined


def near_duplicates(documents: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Words are runs between ASCII white space with A-Z lower-cased; a text's set
    holds its distinct runs of ``like.words`` words, or all its words as one
    run if it has fewer.  NULL, empty and blank texts have empty sets, link with
    nothing and are kept.  ``component_id`` is the smallest doc_id reachable by
    links (NULL ids are passed over), ``kept`` says whether that is the
    document's own.  Repeated rows give repeated results; an empty table gives
    none; other columns are left out.
    """
    sketched, joined = _joined(documents, like, doc_id, text)
    named = sketched.select("doc_id", "node", "n_shingles")
    smallest = named.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    grouped = smallest.join(joined, "node", "left").select("node", "least", "n", F.coalesce("component", "node").alias("component"))
    per_component = grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("n")).where("n > 1")
    lookup = grouped.select("node", "component").join(per_component.drop("n"), "component").select("node", "component_id")
    out = salted_lookup(named, lookup, ["node"], ["doc_id"], salts=8, how="left")
    component_id = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def keep_one_each(documents: DataFrame, like: Likeness = Likeness(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with one row of each group of near-duplicates: of its smallest doc_id (NULL last), then any one.

    Texts without words are no copies of each other and all stay.
    """
    sketched, joined = _joined(documents, like, doc_id, text)
    rows = sketched.where("node is not null").groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    grouped = rows.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node", "n")
    first = grouped.groupBy("component").agg(F.min(order).alias("f"))
    kept = stored(first.select(F.col("f.doc_id").alias("__id"), F.col("f.node").alias("__kept_node"), F.col("f.n").alias("__n")), "kept")
    columns = documents.columns
    typed = documents.select("*", F.lit(None).cast("bigint").alias("__node")).schema

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text):
                nodes = pa.array([_node(s) if len(s) else None for s in _sets(texts, like.words)], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, nodes], names=[*columns, "__node"])

    named = documents.mapInArrow(name, typed)
    known = kept.drop("__n")
    if known.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__kept_node"))
    out = named.where("__node is not null").join(known, same, "left_semi")
    doubled = kept.where("__n > 1").drop("__n")
    if doubled.limit(1).count():
        single = out.join(doubled, same, "left_anti")
        out = single.union(out.join(doubled, same, "left_semi").dropDuplicates([doc_id, "__node"]))
    return out.union(named.where("__node is null")).select(*columns)
