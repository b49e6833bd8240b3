"""The commit log of a sink: one small record per batch, whose appearance makes all the batch's output visible (SNK3, SNK7, STR9)."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell import schemas

#: Records of so many batches are rolled into one file.
ROLL_AT = 64

RECORD_SCHEMA = T.StructType(
    [
        *schemas.BATCH_KEY_SCHEMA.fields,
        *[f for f in schemas.COUNTS_SCHEMA.fields if f.name != "batch_id"],
        T.StructField("key_from", T.StringType()),
        T.StructField("key_to", T.StringType()),
    ]
)


class Folder:
    """Small files on whatever file system Spark reads, each written whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def names(self) -> list[str]:
        """Finished files and folders, in order."""
        if not self._fs.exists(self._path):
            return []
        return sorted(n for s in self._fs.listStatus(self._path) if (n := s.getPath().getName())[0] not in "._")

    def read(self, name: str) -> str | None:
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Appears under its name once it is complete."""
        draft = self._at(f"_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.delete(self._at(name), False)
        if not self._fs.rename(draft, self._at(name)):
            raise OSError(f"could not put {name} into {self._path}")

    def drop(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


@dataclass(frozen=True)
class CommitLog:
    """A folder for each stream with a file for each batch.

    Files of ``ROLL_AT`` batches are rolled into one; what a roll replaces is
    deleted with the next roll, so that a reader who has listed it still finds
    it.  One writer for each stream.
    """

    path: str

    def find(self, spark: SparkSession, stream_id: str, batch_id: int) -> dict | None:
        """The record of a batch, if it is committed; only the latest batch of a stream is ever asked for again."""
        text = Folder(spark, f"{self.path}/{stream_id}").read(f"{batch_id:012d}.json")
        return json.loads(text) if text else None

    def add(self, spark: SparkSession, record: dict) -> None:
        folder = Folder(spark, f"{self.path}/{record['stream_id']}")
        folder.write(f"{record['batch_id']:012d}.json", json.dumps(record) + "\n")
        if record["batch_id"] % ROLL_AT == ROLL_AT - 1:
            self._roll(folder)

    def _roll(self, folder: Folder) -> None:
        names = folder.names()
        rolled = [n for n in names if n.startswith("roll-")]
        upto = rolled[-1].removeprefix("roll-") if rolled else ""
        single = [n for n in names if not n.startswith("roll-")]
        # The latest stays, as it may be asked for.
        fresh = [n for n in single if n > upto][:-1]
        if fresh:
            folder.write(f"roll-{fresh[-1]}", "".join(folder.read(n) for n in fresh))
        for name in (n for n in single if n <= upto):
            folder.drop(name)

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per committed batch."""
        if not Folder(spark, self.path).names():
            return spark.createDataFrame([], RECORD_SCHEMA)
        lines = spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(self.path)
        return lines.dropDuplicates(list(schemas.BATCH_KEYS))


def committed_only(df: DataFrame, commits: str, what: str) -> DataFrame:
    """Rows of committed batches that count some as ``what``; a batch that is being written, or has failed, is not seen."""
    done = CommitLog(commits).read(df.sparkSession).where(F.col(what) > 0).select(*schemas.BATCH_KEYS)
    return df.join(done, list(schemas.BATCH_KEYS), "left_semi").select(df.columns)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """SNK7: received, inserted and rejected rows of every committed batch."""
    return CommitLog(path).read(spark).select(*schemas.COUNTS_SCHEMA.fieldNames(), F.col("stream_id"))
