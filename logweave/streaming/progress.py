"""Progress of long jobs as a table (A4): one row every so many files or seconds, and one at the end.

The numbers come from observations inside the job's own write (:func:`logweave.operators.stats.observe_run`), so nothing is
computed for the report.  A batch job reports after each group of files (``index_directory(files_per_pass=...)``), a
streaming query after each micro-batch, through a listener.  Rows are small files, each written whole; a
report that fails does not stop the job."""

from __future__ import annotations

import json
import threading
import time
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sinks.tombstones import _store

PROGRESS = ("job string, seq bigint, at timestamp, seconds double, files bigint, lines_read bigint, lines_parsed bigint, "
            "lines_skipped bigint, docs bigint, lines_per_second double, final boolean")
COUNTS = ("files", "lines_read", "lines_parsed", "lines_skipped", "docs")


class ProgressLog:
    """Totals of one job so far, written below ``path`` every ``every_files`` files or ``every_seconds`` seconds,
    whichever comes first."""

    def __init__(self, path: str, every_files: int = 20, every_seconds: float = 60.0, job: str | None = None):
        self.path, self.every_files, self.every_seconds = path.rstrip("/"), every_files, every_seconds
        self.job = job or uuid.uuid4().hex
        self.totals = dict.fromkeys(COUNTS, 0)
        self.seq = 0
        self._lock = threading.Lock()  # listeners run in a thread of their own
        self._began = self._last = time.time()
        self._files = self._lines = 0  # at the last row

    def add(self, **counts: int) -> None:
        """What has been done since the last call: any of ``COUNTS``."""
        unknown = set(counts) - set(COUNTS)
        if unknown:
            raise ValueError(f"not counted: {sorted(unknown)}")
        with self._lock:
            for name, n in counts.items():
                self.totals[name] += int(n or 0)
            if self.totals["files"] - self._files >= self.every_files or time.time() - self._last >= self.every_seconds:
                self._write(False)

    def close(self) -> None:
        """The job has ended: the last row."""
        with self._lock:
            self._write(True)

    def _write(self, final: bool) -> None:
        now = time.time()
        rate = (self.totals["lines_read"] - self._lines) / max(now - self._last, 1e-9)
        row = {"job": self.job, "seq": self.seq, "at": time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(now)) + f".{int(now * 1000) % 1000:03d}Z",
               "seconds": round(now - self._began, 3), **self.totals, "lines_per_second": round(rate, 3), "final": final}
        self.seq += 1
        self._last, self._files, self._lines = now, self.totals["files"], self.totals["lines_read"]
        try:
            fs, base = _store(self.path)
            fs.create_dir(base, recursive=True)
            name = f"{base}/{self.job}-{row['seq']:09d}"
            with fs.open_output_stream(f"{name}.tmp") as f:
                f.write((json.dumps(row) + "\n").encode())
            fs.move(f"{name}.tmp", f"{name}.json")
        except Exception as e:  # a report is no reason to stop
            warnings.warn(f"progress was not written: {e}", stacklevel=2)


class ProgressListener(StreamingQueryListener):
    """Adds the observation ``name`` of each micro-batch of any query of the session to a :class:`ProgressLog`.
    ``spark.streams.addListener(...)`` before the start, ``removeListener`` after the end."""

    def __init__(self, log: ProgressLog, name: str = "logweave_run"):
        self.log, self.name = log, name
        self._seen: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        key = (str(progress.id), progress.batchId)
        if row is not None and key not in self._seen and progress.numInputRows:
            self._seen.add(key)
            values = row.asDict()
            self.log.add(**{c: values[c] for c in COUNTS if c in values})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all jobs that report below ``path``: ``PROGRESS``."""
    return spark.read.schema(PROGRESS).option("pathGlobFilter", "*.json").json(path)
