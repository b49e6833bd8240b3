"""Progress of running queries as a log: SNK8, STR8, FLT12."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from threading import Event, Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from sievewell import schemas
from sievewell.sources.readers import read_log_csv
from sievewell.streaming.commits import Folder

log = logging.getLogger(__name__)

PROGRESS_LOG_SCHEMA = T.StructType(
    [T.StructField("stream_id", T.StringType()), *schemas.PROGRESS_SCHEMA.fields]
)


def progress_row(progress, stream_id: str | None = None) -> tuple:
    """The logged fields of one progress report (object or dictionary form)."""
    get = progress.get if isinstance(progress, dict) else lambda name: getattr(progress, name)
    took = (get("durationMs") or {}).get("triggerExecution")
    return (
        stream_id or str(get("id")),
        get("batchId"),
        get("timestamp"),
        get("numInputRows"),
        float(get("inputRowsPerSecond") or 0.0),
        float(get("processedRowsPerSecond") or 0.0),
        took,
    )


def progress_frame(spark: SparkSession, reports: Iterable, stream_id: str | None = None) -> DataFrame:
    """SNK8: given reports as a log frame, empty batches left out.

    ``query.recentProgress`` holds the last 100 only; a ``ProgressRecorder``
    logs them all.
    """
    rows = [row for row in (progress_row(p, stream_id) for p in reports) if row[3]]
    return spark.createDataFrame(rows, PROGRESS_LOG_SCHEMA)


def _csv_field(value) -> str:
    if value is None:
        return ""
    if not isinstance(value, str):
        return str(value)
    return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'


class RollingLog:
    """SNK8: a folder of header CSV files that stay few: n appends leave at most log2(n) + 1 files in use.

    A file is named by the appends it holds, ``from-to``.  Two neighbours of
    equal span are rolled into one, which appears whole before what it replaces
    is deleted; ``read`` counts neither twice in between, and a reader that had
    listed a deleted file fails and can ask again.  At rest the folder can be
    read as a whole.  Appending starts no Spark job.  One writer.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PROGRESS_LOG_SCHEMA):
        self._spark, self._path, self._schema = spark, path, schema

    @staticmethod
    def _span(name: str) -> tuple[int, int]:
        first, last = name.removesuffix(".csv").split("-")
        return int(first), int(last)

    @classmethod
    def _in_use(cls, names: Iterable[str]) -> list[str]:
        """Files not held by a wider one, in order."""
        out: list[str] = []
        for name in sorted(names, key=lambda n: (cls._span(n)[0], -cls._span(n)[1])):
            if not out or cls._span(name)[1] > cls._span(out[-1])[1]:
                out.append(name)
        return out

    def files(self) -> list[str]:
        return self._in_use(Folder(self._spark, self._path).names())

    def append(self, rows: Iterable[tuple]) -> None:
        folder = Folder(self._spark, self._path)
        used = self._in_use(folder.names())
        header = ",".join(self._schema.fieldNames()) + "\n"
        body = "".join(",".join(map(_csv_field, row)) + "\n" for row in rows)
        first = last = self._span(used[-1])[1] + 1 if used else 0
        text = header + body
        # Spans are powers of two, so equal neighbours meet as digits carry over; all appends of a carry are one write.
        while used and self._span(used[-1])[1] - self._span(used[-1])[0] == last - first:
            before = used.pop()
            text = folder.read(before) + text.removeprefix(header)
            first = self._span(before)[0]
        folder.write(f"{first:012d}-{last:012d}.csv", text)
        names = folder.names()
        for name in set(names) - set(self._in_use(names)):
            folder.drop(name)

    def read(self) -> DataFrame:
        """All rows; an empty or absent log gives none."""
        files = self.files()
        if not files:
            return self._spark.createDataFrame([], self._schema)
        return read_log_csv(self._spark, [f"{self._path}/{name}" for name in files], self._schema)


class ProgressRecorder(StreamingQueryListener):
    """STR8/SNK8: logs the life of queries and appends non-empty progress to a ``RollingLog``.

    Every row is appended as it comes; with ``flush_every`` above 1 rows are
    kept until so many have come together or a query ends, which writes less
    often but loses the pending rows if the process dies.  ``stream_id`` names
    the rows; the default is each query's own id.
    """

    def __init__(self, spark: SparkSession, path: str, stream_id: str | None = None, flush_every: int = 1):
        self._stream_id, self._flush_every = stream_id, flush_every
        self._log = RollingLog(spark, path)
        self._ended = Event()
        self._rows: list[tuple] = []
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:
        log.info("stream started: id=%s name=%s", event.id, event.name)

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress, self._stream_id)
        log.info("batch %s: %s rows in %s ms", row[1], row[3], row[6])
        if not row[3]:
            return
        with self._lock:
            self._rows.append(row)
            due = len(self._rows) >= self._flush_every
        if due:
            self.flush()

    def onQueryIdle(self, event) -> None:
        """No new data: nothing to record."""

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("stream failed: id=%s %s", event.id, event.exception)
        else:
            log.info("stream ended: id=%s", event.id)
        self.flush()
        self._ended.set()

    def wait_ended(self, timeout: float = 60.0) -> bool:
        """Wait until a query has ended and all its rows are logged; reports come on a thread of their own."""
        return self._ended.wait(timeout)

    def flush(self) -> int:
        """Append what is pending; the number of rows written."""
        with self._lock:
            pending, self._rows = self._rows, []
            if pending:
                self._log.append(pending)
        return len(pending)
