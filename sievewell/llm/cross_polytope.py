"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

A fast Hadamard rotation (three rounds of fixed random signs and a Hadamard
transform) turns a vector in O(d log d); its hash is the coordinate of largest
magnitude, with its sign.  A bucket joins three such hashes.  Every vector is
put into the likeliest few buckets of every table, so that a hash that nearly
fell the other way is probed as well.  Buckets are cut into blocks of bounded
size, a task compares one pair of blocks by exact cosines, and a pair counts
where it first meets.  Equal vectors are one class with a number of copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.graph import components
from sievewell.llm.store import stored
from sievewell.llm.words import mix
from sievewell.plans.skew import salted_lookup

TABLES = 6
HASHES = 3
PROBES = 6
#: Candidates per rotation from which probes are combined.
CHOICES = 3
#: Classes in a block; a task compares two blocks at a time.
BLOCK = 1024
_ROWS = 2048

Group = dict[str, np.ndarray]


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (a power of two wide) after three rounds of signs and Hadamard transform."""
    for s in signs:
        x = x * s
        n, d = x.shape
        step = 1
        while step < d:
            pairs = x.reshape(n, d // (2 * step), 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
            step *= 2
        x = x / np.sqrt(d)
    return x


def buckets(x: np.ndarray) -> np.ndarray:
    """uint64 [vectors, TABLES * PROBES]: the buckets of unit vectors, likeliest first within a table."""
    n, d = x.shape
    width = 1 << max(1, int(np.ceil(np.log2(max(d, 2)))))
    padded = np.zeros((n, width))
    padded[:, :d] = x
    random = np.random.default_rng(97 + width)
    choices = min(CHOICES, width)
    combos = np.array(list(itertools.product(range(choices), repeat=HASHES)))
    out = np.empty((n, TABLES, PROBES), dtype=np.uint64)
    for t in range(TABLES):
        values, losses = [], []
        for _ in range(HASHES):
            y = rotate(padded, random.choice([-1.0, 1.0], size=(3, width)))
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, :choices]
            high = np.take_along_axis(size, top, axis=1)
            values.append((2 * top + (np.take_along_axis(y, top, axis=1) < 0)).astype(np.uint64))
            losses.append(high[:, :1] ** 2 - high**2)
        loss = sum(losses[h][:, combos[:, h]] for h in range(HASHES))
        best = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        if best.shape[1] < PROBES:
            best = np.pad(best, ((0, 0), (0, PROBES - best.shape[1])), mode="edge")
        key = np.full(best.shape, np.uint64(((t + 1) * 0x9E3779B97F4A7C15 + width) % 2**64))
        for h in range(HASHES):
            key = mix(key * np.uint64(31) + np.take_along_axis(values[h], combos[best, h], axis=1))
        out[:, t] = key
    return out.reshape(n, TABLES * PROBES)


def _usable(column: pa.Array, wide: str) -> list[np.ndarray | None]:
    out: list[np.ndarray | None] = []
    for v in column:
        values = None if v.as_py() is None else v.values
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        x = np.asarray(values).astype(wide) + 0.0
        out.append(x if np.isfinite(x).all() and x.any() else None)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sketches(vectors: DataFrame, wide: str) -> DataFrame:
    """vec_id, node (NULL: links with nothing), the vector's bytes and its buckets."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                found = _usable(part.column(1), wide)
                node: list[int | None] = [None] * len(found)
                where: list[list | None] = [None] * len(found)
                for d in {len(x) for x in found if x is not None}:
                    rows = [i for i, x in enumerate(found) if x is not None and len(x) == d]
                    x = np.stack([found[i] for i in rows])
                    bits = x.astype(np.float64).view(np.uint64)
                    odd = 2 * np.arange(d, dtype=np.uint64) + np.uint64(1)
                    names = mix(mix(bits * odd + odd).sum(axis=1, dtype=np.uint64) + np.uint64(d)).view(np.int64)
                    keys = buckets(_unit(x)).view(np.int64)
                    for i, name, k in zip(rows, names.tolist(), keys):
                        node[i], where[i] = name, k
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(node, pa.int64()), pa.array([None if x is None else x.tobytes() for x in found], pa.binary()), pa.array(where, pa.list_(pa.int64()))],
                    names=["vec_id", "node", "vector", "buckets"],
                )

    return vectors.mapInArrow(sketch, "vec_id bigint, node bigint, vector binary, buckets array<bigint>")


def each_group(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], columns: Callable[[pa.RecordBatch], Group]) -> Iterator[Group]:
    """Runs of rows with equal ``keys``, whole though they cross batches."""
    rest: Group | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None and not batch.num_rows:
            continue
        now = columns(batch) if batch is not None else None
        if rest is not None:
            now = rest if now is None else {k: np.concatenate([rest[k], v]) for k, v in now.items()}
        if now is None:
            return
        size = len(now[keys[0]])
        new = np.zeros(size, dtype=bool)
        new[0] = True
        for k in keys:
            new[1:] |= now[k][1:] != now[k][:-1]
        starts = np.flatnonzero(new)
        whole = np.append(starts, size) if batch is None else starts
        for a, b in itertools.pairwise(whole.tolist()):
            yield {k: v[a:b] for k, v in now.items()}
        rest = {k: v[whole[-1] :] for k, v in now.items()} if batch is not None else None


def _compare(group: Group, least: float, wide: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links counted per member (weighted by copies), and for every member one it shares a component with."""
    size = len(group["node"])
    links, root = np.zeros(size, dtype=np.int64), np.arange(size)
    lengths = np.fromiter((len(v) for v in group["vector"]), dtype=np.int64, count=size)
    same_side = group["low"][0] == group["high"][0]
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        left = own if same_side else own[group["own"][own] == group["low"][0]]
        right = own if same_side else own[group["own"][own] != group["low"][0]]
        if not len(left) or not len(right) or (same_side and len(own) < 2):
            continue
        x = _unit(np.frombuffer(b"".join(group["vector"][left]), dtype=wide).reshape(len(left), -1))
        y = x if same_side else _unit(np.frombuffer(b"".join(group["vector"][right]), dtype=wide).reshape(len(right), -1))
        near = x @ y.T >= least
        if same_side:
            np.fill_diagonal(near, False)
        if not near.any():
            continue
        i, j = np.nonzero(near)
        for at in range(0, len(i), 1 << 15):
            a, b = left[i[at : at + (1 << 15)]], right[j[at : at + (1 << 15)]]
            # A pair counts in the first of their common buckets, in the order of the first one's list.
            low, high = np.where(group["node"][a] < group["node"][b], a, b), np.where(group["node"][a] < group["node"][b], b, a)
            ours, theirs = group["tags"][low], group["tags"][high]
            met = np.full(len(a), ours.shape[1])
            for t in reversed(range(ours.shape[1])):
                met[(theirs == ours[:, t : t + 1]).any(axis=1)] = t
            here = ours[np.arange(len(a)), np.minimum(met, ours.shape[1] - 1)] == group["bucket"][:1]
            np.add.at(links, a[here], group["copies"][b[here]])
            if not same_side:
                np.add.at(links, b[here], group["copies"][a[here]])
        label = np.arange(size)
        while True:
            before = label.copy()
            big = np.where(near, label[right][None, :], size).min(axis=1)
            label[left] = np.minimum(label[left], big)
            big = np.where(near, label[left][:, None], size).min(axis=0)
            label[right] = np.minimum(label[right], big)
            if (label == before).all():
                break
        root = np.minimum(root, label)
    return links, root, group["node"][root]


def near_vectors(vectors: DataFrame, least: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    ``n_links`` counts the other vectors found with a cosine (in double
    precision) of at least ``least``, equal vectors included; ``component_id``
    is the smallest vec_id reachable by links, ``kept`` whether that is the
    vector's own.  Vectors that are NULL, empty, zero or hold a NULL, NaN or
    infinite component link with nothing; vectors of different lengths are not
    compared.  Repeated rows are copies of each other; an empty table gives no
    rows; other columns are left out.
    """
    element = vectors.schema[embedding].dataType.elementType.simpleString()
    wide = "<f4" if element == "float" else "<f8"
    values = F.col(embedding) if element in ("float", "double") else F.col(embedding).cast("array<double>")
    sketched = stored(_sketches(vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("embedding")), wide), "vectors")
    usable = sketched.where("node is not null")
    counts = usable.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(usable.select("node", "vector", "buckets").dropDuplicates(["node"]).join(counts, "node"), "classes")
    placed = classes.select(F.explode(F.array_distinct("buckets")).alias("bucket"), "node")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = shared.select("bucket", F.ceil(F.col("size") / BLOCK).cast("bigint").alias("blocks"))
    members = placed.join(shared, "bucket").join(classes.select("node", "vector", "copies", "buckets"), "node")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    paired = members.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")).select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "vector", "copies", "buckets"
    )
    dealt = paired.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")

    def columns(batch: pa.RecordBatch) -> Group:
        out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "low", "high", "own", "node", "copies")}
        out["vector"] = np.array(batch.column("vector").to_pylist(), dtype=object)
        out["tags"] = np.asarray(batch.column("buckets").flatten()).reshape(batch.num_rows, -1)
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, links, roots, held = [], [], [], 0
        for group in itertools.chain(each_group(batches, ("bucket", "low", "high"), columns), [None]):
            if group is not None and len(group["node"]) > 1:
                n, root, other = _compare(group, least, wide)
                some = np.flatnonzero((n > 0) | (root != np.arange(len(n))))
                names.append(group["node"][some])
                links.append(n[some])
                roots.append(other[some])
                held += len(some)
            if held > 50_000 or (group is None and held):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (names, links, roots)], names=["node", "links", "root"])
                names, links, roots, held = [], [], [], 0

    found = stored(dealt.mapInArrow(compare, "node bigint, links bigint, root bigint"), "vector-links")
    joined = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "copies", "least").join(linked, "node", "left").join(joined, "node", "left")
    named = named.select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    lookup = named.join(smallest, "component").select("node", "n_links", "component_id")
    out = salted_lookup(sketched.select("vec_id", "node"), lookup, ["node"], ["vec_id"], salts=8, how="left")
    component_id = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component_id.alias("component_id"), F.col("vec_id").eqNullSafe(component_id).alias("kept")
    )
