"""Audit of how filters interact, by contractions of a contingency tensor.

Documents are counted by part (a language) and by which of the five filters
they fail.  The 32 counts of a part, reshaped to 2 x 2 x 2 x 2 x 2, are its
contingency tensor: axis f has the documents that pass and fail filter f.
Whatever a step of an order of filters does is a contraction: each axis is
met by a selector that takes pass, fail or all.  One einsum gives every step
of all 120 orders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewell.llm.store import stored

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
#: Parts that are contracted together; each gives 600 rows.
PARTS_AT_ONCE = 64

SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)

_SPACE = r"[\x20\x09-\x0D]+"
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def failures(text: Column) -> Column:
    """Which of filters A to D a text fails, as a sum of 1, 2, 4 and 8."""
    # A leading and a trailing separator leave an empty piece each.
    words = F.array_remove(F.split(text, _SPACE), "")

    def bits(w: Column) -> Column:
        n, length = F.size(w), F.char_length(text)
        upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
        fails = [n < 200, 100 * F.size(F.array_distinct(w)) < 50 * n, 100 * upper > 3 * length, F.rlike(text, F.lit("[#$%&*|]"))]
        return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))

    # The words are made once and then named.
    return F.get(F.transform(F.array(words), bits), F.lit(0)).cast("int")


def judged(documents: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, part, fails, good, toxic) of each document, without its text.

    ``fails`` has filters A to D.  A document is good (toxic) if any row of
    the labels says so; labels without an id belong to no document.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.unhex(F.sha2(t, 256)).alias("digest"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failures(t).alias("fails"),
    )
    marks = (
        labels.where(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("bigint").alias("labelled"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    # Documents without an id meet no label; they are spread by their texts instead of meeting in one task.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("bigint"))
    met = (F.col("doc_id") == F.col("labelled")) & (F.col("spread") == F.col("no_spread"))
    joined = docs.withColumn("spread", spread).join(marks.withColumn("no_spread", F.lit(0).cast("bigint")), met, "left")
    zero = F.lit(0)
    return joined.select("doc_id", "digest", "part", "fails", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))


def contingency(rows: DataFrame) -> DataFrame:
    """(part, n, good, toxic): for each part three arrays of 32 counts, by failed filters; A is the first axis.

    ``rows`` are those of ``judged``, read twice.  A document fails E if a
    smaller id has the same text.  Those that do not are the first of their
    text, and all rows that share its id; Spark leaves one row of a text for
    each task before it shuffles them.  Without an id a document neither
    fails E nor makes others fail.
    """
    by_id = Window.partitionBy("digest").orderBy("doc_id")
    first = rows.where(F.col("doc_id").isNotNull()).withColumn("place", F.rank().over(by_id)).where(F.col("place") == 1).drop("place")
    passing = first.unionByName(rows.where(F.col("doc_id").isNull()))

    def counted(some: DataFrame) -> DataFrame:
        sums = F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
        return some.groupBy("part", "fails").agg(*sums)

    # What fails E is what there is less what passes.
    last = 1 << (len(FILTERS) - 1)
    whole, kept = counted(rows), counted(passing)
    gone = kept.select("part", (F.col("fails") + last).alias("fails"), *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    cells = whole.withColumn("fails", F.col("fails") + last).unionByName(kept).unionByName(gone)
    # The tensor's first axis varies slowest, the bits of ``fails`` start with A.
    place = [sum(((k >> (len(FILTERS) - 1 - f)) & 1) << f for f in range(len(FILTERS))) for k in range(CELLS)]

    def tensor(name: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("fails") == p, F.col(name)).otherwise(0)) for p in place]).alias(name)

    return cells.groupBy("part").agg(*[tensor(c) for c in ("n", "good", "toxic")])


def orders(filters: str = FILTERS) -> list[tuple[int, ...]]:
    return list(permutations(range(len(filters))))


def selectors() -> dict[str, np.ndarray]:
    """For every step of every order, what it takes of each axis: arrays of (steps, axes, 2)."""

    def select(choice) -> np.ndarray:
        return np.array([[choice(order, step, axis) for axis in range(len(FILTERS))] for order in orders() for step in range(len(order))])

    return {
        "kept": select(lambda order, step, axis: _PASS if axis in order[: step + 1] else _ALL),
        "removed": select(lambda order, step, axis: _FAIL if axis == order[step] else _PASS if axis in order[:step] else _ALL),
        "failing": select(lambda order, step, axis: _FAIL if axis == order[step] else _ALL),
        "unique_fails": select(lambda order, step, axis: _FAIL if axis == order[step] else _PASS),
    }


def contracted(tensors: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """(parts, steps): the documents that each step's selector takes of each part's tensor."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *np.moveaxis(selector, 1, 0), optimize="optimal")


def audited(parts: Sequence[str], n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> pa.RecordBatch:
    """The audit of some parts; ``n``, ``good`` and ``toxic`` are (parts, 32) counts."""
    shape = (len(parts),) + (2,) * len(FILTERS)
    n, good, toxic = (x.reshape(shape) for x in (n, good, toxic))
    takes = selectors()
    acting = np.array([f for order in orders() for f in order])
    removed = contracted(n, takes["removed"])
    # A filter's removals in all orders, whatever its step.
    in_all = removed @ (acting[:, None] == np.arange(len(FILTERS))).astype(np.int64)
    names = ["".join(FILTERS[f] for f in order) for order in orders()]
    steps = len(FILTERS)
    columns = [
        pa.array(np.repeat(np.array(parts, dtype=object), len(acting)), pa.string()),
        pa.array(np.tile(np.repeat(names, steps), len(parts)), pa.string()),
        pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(names) * len(parts))),
        *[
            pa.array(x.ravel().astype(np.int64))
            for x in (
                contracted(n, takes["kept"]), removed, contracted(n, takes["failing"]) - removed, contracted(n, takes["unique_fails"]),
                contracted(good, takes["removed"]), contracted(toxic, takes["removed"]), in_all[:, acting],
            )
        ],
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def audit_filters(documents: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    A NULL text is an empty one, a NULL part the empty string; other columns
    are not looked at.  An empty table has no parts and gives no rows.
    """
    rows = stored(judged(documents, labels, part, doc_id, text), "filter-audit")

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                some = batch.slice(at, PARTS_AT_ONCE)
                counts = [np.array(some.column(k).to_pylist(), dtype=np.int64) for k in (1, 2, 3)]
                yield audited(some.column(0).to_pylist(), *counts)

    return contingency(rows).mapInArrow(contract, SCHEMA)
