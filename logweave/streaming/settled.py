"""Watch a directory for files that are whole (T1): a stream of listings.

Spark's file source takes a file when it first sees it, half written or not, and applies a general name rule only
to lines it has read.  The stream source here lists the directory itself: the name rule is applied to names, and a
file is taken when size and time have been the same for ``settle_seconds`` over two listings or more.  What is
taken becomes the next numbered snapshot in ``state_dir``, written before its number is an offset of the
stream, so a restart takes the same files for the same batch, and each file once.

The stream's rows are files, not lines: in each micro-batch they are read by byte ranges
(:mod:`logweave.sources.ranges`), numbered exactly, as long as they were when they were taken.  Files that do not
match are never opened.  The driver holds the listing: names, sizes and times."""

from __future__ import annotations

import json
import re
import sys
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir
from ..sinks.tombstones import _store, modified, write_tombstones
from ..sources.files import DEFAULT_MATCH, match_regex, read_log_lines
from .watch import _ledger, clean_watched

FILES = "file string, uri string, size bigint, mtime timestamp"


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.state = options["path"].rstrip("/"), options["state_dir"].rstrip("/")
        self.rule = options.get("rule") or None
        self.settle, self.most = float(options["settle"]), int(options["most"])
        self.seen: dict[str, list] | None = None  # uri -> [size, ms, since]
        self.taken: set[str] = set()
        self.version = 0

    # --- state ---
    def _read(self, name: str):
        from pyarrow import fs as pafs

        fs, base = _store(f"{self.state}/{name}")
        if fs.get_file_info(base).type != pafs.FileType.File:
            return None
        with fs.open_input_stream(base) as f:
            return json.loads(f.read().decode())

    def _write(self, name: str, value) -> None:
        fs, base = _store(f"{self.state}/{name}")
        fs.create_dir(base.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(f"{base}.tmp") as f:
            f.write(json.dumps(value).encode())
        fs.move(f"{base}.tmp", base)

    def _load(self) -> None:
        if self.seen is None:
            self.seen = self._read("seen.json") or {}
            while (files := self._read(f"take-{self.version + 1}.json")) is not None:
                self.version += 1
                self.taken.update(f["uri"] for f in files)

    # --- listing ---
    def _listing(self) -> dict[str, tuple[int, int]]:
        from pyarrow import fs as pafs

        fs, base = _store(self.path)
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(base, recursive=True)):
            if not info.is_file or not info.size or any(p[:1] in "._" for p in info.path[len(base):].strip("/").split("/")):
                continue
            if self.rule is None or re.search(self.rule, info.base_name):
                uri = self.path if "://" in self.path or self.path.startswith("file:") else "file://" + quote(self.path)
                out[f"{uri}/{quote(info.path[len(base):].strip('/'))}"] = (info.size, modified(info))
        return out

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        self._load()
        now = time.time()
        seen, settled = {}, []
        for uri, (size, ms) in sorted(self._listing().items()):
            if uri in self.taken:
                continue
            before = self.seen.get(uri)
            since = before[2] if before and before[:2] == [size, ms] else now
            seen[uri] = [size, ms, since]
            if before and now - since >= self.settle:
                settled.append({"uri": uri, "size": size, "ms": ms})
        if seen != self.seen:
            self._write("seen.json", seen)
        self.seen = seen
        settled = settled[: self.most]  # the others are taken by the next batches
        if settled:
            self._write(f"take-{self.version + 1}.json", settled)
            self.version += 1
            self.taken.update(f["uri"] for f in settled)
        return {"version": self.version}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(v) for v in range(start["version"] + 1, end["version"] + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from urllib.parse import unquote

        for f in self._read(f"take-{partition.value}.json") or ():
            name = re.sub(r"^file:(//)?(?=/)", "", unquote(f["uri"]))
            yield name, f["uri"], f["size"], datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=f["ms"])


class SettledFiles(DataSource):
    """``spark.readStream.format("logweave_settled")``, used by :func:`watch_settled`."""

    @classmethod
    def name(cls) -> str:
        return "logweave_settled"

    def schema(self) -> str:
        return FILES

    def streamReader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def settled_files(spark: SparkSession, path: str, state_dir: str, match: str | None = DEFAULT_MATCH, settle_seconds: float = 5.0,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the matching files below ``path`` that are whole: ``FILES``, each file once.  Hidden files (a name, or a
    folder's, that begins with ``.`` or ``_``) and empty ones are passed over."""
    spark.dataSource.register(SettledFiles)
    options = {"path": path, "state_dir": state_dir, "rule": match_regex(match) or "", "settle": settle_seconds, "most": max_files_per_trigger or 1 << 40}
    return spark.readStream.format(SettledFiles.name()).options(**options).load()


def watch_settled(spark: SparkSession, path: str, handler: Callable[[DataFrame, int], None], checkpoint: str,
                  match: str | None = DEFAULT_MATCH, trigger: dict | None = None, settle_seconds: float = 5.0,
                  max_files_per_trigger: int | None = None, clean_source: str | None = None, archive_dir: str | None = None,
                  line_sep: str = "\n", charset: str = "UTF-8") -> StreamingQuery:
    """Like :func:`logweave.streaming.watch.watch_directory`, for files that are written in place over some time: the
    handler gets ``lines(file, line_num, line)`` of files that have not changed for ``settle_seconds``.  Any name rule,
    any charset whose lines can be told apart anywhere, gzip too.  ``trigger``: every so often (the default:
    ``{"processingTime": "5 seconds"}``); one ``availableNow`` run takes what earlier runs have seen settle."""
    if clean_source not in (None, "delete", "archive") or (clean_source == "archive") != bool(archive_dir):
        raise ValueError("clean_source is 'delete', or 'archive' with archive_dir")
    checkpoint_dir(spark)
    if clean_source:
        clean_watched(spark, checkpoint, archive_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if clean_source:
            clean_watched(session, checkpoint, archive_dir)
        files = batch.checkpoint()
        if files.isEmpty():
            return
        handler(read_log_lines(session, path, match, charset, line_sep, files=files, allow_empty=True), batch_id)
        if clean_source:
            write_tombstones(files, _ledger(checkpoint), str(batch_id))

    stream = settled_files(spark, path, f"{checkpoint.rstrip('/')}/settled", match, settle_seconds, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the source's worker need not have this package installed
