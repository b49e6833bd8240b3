"""A persistent index of stored keys: which of a batch's keys are stored, without reading all keys (SNK5, DED2, JON7).

Keys of the latest batches are read from the table's own files.  Every
``COMPACT_AT`` batches they move into a run: key files by hash bucket, and for
each bucket a Bloom filter.  ``FAN_IN`` runs of a level are merged into one of
the next, so that there are few runs however many batches there were.  What a
batch opens are files whose key range it meets and, of large runs, the buckets
whose filter lets one of its keys through.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell.streaming.commits import CommitLog, Folder

COMPACT_AT = 16
FAN_IN = 8
#: Keys of a run up to which its filters are not asked: reading them would take as long as reading the keys.
FILTER_FROM = 1_000_000
KEYS_PER_BUCKET = 250_000
#: 64-bit words of a filter for each key: 16 bits, of which a key sets four in one word.
WORDS_PER_KEY = 0.25
_BITS = 4


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _mark(key: Column) -> Column:
    """The bits that a key sets within its word."""
    h = F.xxhash64(F.lit("bits"), key)
    place = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_BITS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _word(key: Column, words: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), key), F.lit(words) if isinstance(words, int) else words).cast("int")


def filters(keys: DataFrame, words: int) -> DataFrame:
    """(bucket, filter) of (bucket, key): ``words`` 64-bit words for each bucket."""
    marks = keys.select("bucket", _word(F.col("key"), words).alias("at"), _mark(F.col("key")).alias("mark"))
    blank = keys.select("bucket").distinct().select("bucket", F.explode(F.sequence(F.lit(0), F.lit(words - 1))).alias("at"), F.lit(0).cast("bigint").alias("mark"))
    whole = marks.unionByName(blank).groupBy("bucket", "at").agg(F.bit_or("mark").alias("mark"))
    return whole.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "mark"))), lambda x: x["mark"]).alias("filter"))


def may_hold(bloom: Column, key: Column) -> Column:
    """False only for keys that are not in the filter."""
    mark = _mark(key)
    return F.get(bloom, _word(key, F.size(bloom))).bitwiseAND(mark) == mark


def _column(spark: SparkSession, name: str, kind: T.DataType, paths: list[str]) -> DataFrame:
    """One column of parquet folders; their partition folders are not columns here."""
    shape = T.StructType([T.StructField(name, kind)])
    return spark.read.schema(shape).option("recursiveFileLookup", True).parquet(*paths).toDF("key")


@dataclass(frozen=True)
class Run:
    """A merged part of the index; ``key_from`` and ``key_to`` are None for keys that are not text."""

    name: str
    level: int
    rows: int
    buckets: int
    key_from: str | None
    key_to: str | None


@dataclass
class _State:
    runs: list[Run]
    upto: dict[str, int]
    recent: list[dict]
    version: int


def _apart(a_from, a_to, b_from, b_to) -> bool:
    return None not in (a_from, a_to, b_from, b_to) and (a_to < b_from or b_to < a_from)


@dataclass
class KeyIndex:
    """The keys stored in a table of batch folders; the table's only writer keeps it.

    ``folder_of`` gives a batch's folder.  The index is lost without harm: it
    can be built anew from the commit log and the table.
    """

    table: str
    commits: str
    key: str
    key_type: T.DataType
    folder_of: object
    filter_from: int = FILTER_FROM
    keys_per_bucket: int = KEYS_PER_BUCKET
    compact_at: int = COMPACT_AT
    fan_in: int = FAN_IN
    _state: _State | None = field(default=None, repr=False)

    @property
    def path(self) -> str:
        return f"{self.table}/_index"

    def load(self, spark: SparkSession) -> _State:
        """Once for each process: the latest manifest, and the committed batches since."""
        if self._state is None:
            folder = Folder(spark, self.path)
            names = [n for n in folder.names() if n.startswith("manifest-")]
            found = json.loads(folder.read(names[-1])) if names else {"runs": [], "upto": {}, "version": 0}
            upto = found["upto"]
            done = CommitLog(self.commits).read(spark).where("inserted > 0")
            if upto:
                known = spark.createDataFrame(list(upto.items()), "stream_id string, upto bigint")
                done = done.join(known, "stream_id", "left").where("upto IS NULL OR batch_id > upto")
            recent = [r.asDict() for r in done.orderBy("stream_id", "batch_id").collect()]
            self._state = _State([Run(**r) for r in found["runs"]], upto, recent, found["version"])
        return self._state

    def stored(self, spark: SparkSession, keys: DataFrame, key_from: object, key_to: object, but: tuple[str, int]) -> DataFrame | None:
        """Stored keys among which are all of ``keys`` that are stored outside the batch ``but``; None if there are none.

        ``keys`` has the one column ``key``, with values from ``key_from`` to ``key_to``.
        """
        state, parts = self.load(spark), []
        lowest, highest = (x if isinstance(x, str) else None for x in (key_from, key_to))
        near = [r for r in state.recent if (r["stream_id"], r["batch_id"]) != but and not _apart(lowest, highest, r["key_from"], r["key_to"])]
        if near:
            parts.append(_column(spark, self.key, self.key_type, [self.folder_of(r["stream_id"], r["batch_id"]) for r in near]))
        paths = []
        for run in state.runs:
            if not _apart(lowest, highest, run.key_from, run.key_to):
                paths += self._files(spark, run, keys)
        if paths:
            parts.append(_column(spark, "key", self.key_type, paths))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _files(self, spark: SparkSession, run: Run, keys: DataFrame) -> list[str]:
        """Folders of a run's buckets that may hold one of the keys."""
        top = f"{self.path}/{run.name}"
        if run.rows < self.filter_from:
            return [f"{top}/keys"]
        blooms = spark.read.parquet(f"{top}/filters")
        # As many rows as the run has buckets at the most.
        met = keys.select("key", bucket_of(F.col("key"), run.buckets).alias("bucket")).join(blooms, "bucket")
        hit = met.where(may_hold(F.col("filter"), F.col("key"))).select("bucket").distinct().collect()
        return [f"{top}/keys/bucket={r.bucket}" for r in hit]

    def note(self, spark: SparkSession, record: dict) -> None:
        """A batch has been committed."""
        if self._state is None or not record["inserted"]:
            return
        state = self._state
        state.recent = [r for r in state.recent if (r["stream_id"], r["batch_id"]) != (record["stream_id"], record["batch_id"])] + [record]
        if len(state.recent) >= self.compact_at:
            self._compact(spark)

    def _compact(self, spark: SparkSession) -> None:
        """Recent batches become a run; runs of a full level become one of the next."""
        state = self._state
        folders = [self.folder_of(r["stream_id"], r["batch_id"]) for r in state.recent]
        keys = _column(spark, self.key, self.key_type, folders)
        level, merged = 0, []
        ranges = [(r["inserted"], r["key_from"], r["key_to"]) for r in state.recent]
        while len(same := [r for r in state.runs if r.level == level]) >= self.fan_in - 1:
            keys = keys.unionByName(_column(spark, "key", self.key_type, [f"{self.path}/{r.name}/keys" for r in same]))
            ranges += [(r.rows, r.key_from, r.key_to) for r in same]
            merged += same
            level += 1
        run = self._write(spark, keys, level, ranges)
        state.runs = [r for r in state.runs if r not in merged] + [run]
        for r in state.recent:
            state.upto[r["stream_id"]] = max(r["batch_id"], state.upto.get(r["stream_id"], -1))
        state.recent, state.version = [], state.version + 1
        folder = Folder(spark, self.path)
        manifest = {"runs": [r.__dict__ for r in state.runs], "upto": state.upto, "version": state.version}
        folder.write(f"manifest-{state.version:012d}", json.dumps(manifest))
        # The writer alone reads the index, so that what the new manifest does not name can go.
        keep = {f"manifest-{state.version:012d}", *[r.name for r in state.runs]}
        for name in folder.names():
            if name not in keep:
                folder.drop(name)

    def _write(self, spark: SparkSession, keys: DataFrame, level: int, ranges: list[tuple]) -> Run:
        rows = sum(r[0] for r in ranges)
        known = all(isinstance(x, str) for r in ranges for x in r[1:])
        bounds = (min(r[1] for r in ranges), max(r[2] for r in ranges)) if known else (None, None)
        run = Run(f"run-{uuid.uuid4().hex}", level, rows, max(1, -(-rows // self.keys_per_bucket)), *bounds)
        placed = keys.withColumn("bucket", bucket_of(F.col("key"), run.buckets))
        if run.buckets > 1:
            placed = placed.repartition(run.buckets, "bucket")
        else:
            placed = placed.coalesce(1)
        placed.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(f"{self.path}/{run.name}/keys")
        if rows >= self.filter_from:
            written = spark.read.parquet(f"{self.path}/{run.name}/keys").select(F.col("bucket").cast("int").alias("bucket"), "key")
            words = max(1, int(-(-rows // run.buckets) * WORDS_PER_KEY))
            filters(written, words).write.parquet(f"{self.path}/{run.name}/filters")
        return run
