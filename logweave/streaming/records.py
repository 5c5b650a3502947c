"""Multi-line records of streams, with the open record of each file in streaming state (T3).

``stream_records`` takes a stream of classified lines ``(file, line_num, state, text)``, e.g. of the table to which
:func:`logweave.streaming.tail.tail_once` appends, and gives each record when its end is seen (the next
START, or its END), or when no line of its file has come for ``idle_seconds``: a processing-time timer
emits what is open.  The reference drops that last record in tail mode.

State is keyed by file and holds the open record only: counters, and its text as a list of pieces, one
appended for each micro-batch, so a long record is not rewritten as it grows.  At ``piece_chars`` the text so far
leaves as a part of the record and its pieces are dropped, so neither state nor a value grows with a
record's length; parts are numbered, and the last one has ``closed``.  A file without an open record has no
state.  The state store and the source's offsets are committed together, so a restart neither loses nor
repeats a line; with an idempotent or transactional sink each part is delivered once.

Lines of a file have to arrive in order of micro-batches; inside one they are sorted here.  Limit what a
trigger takes (``maxFilesPerTrigger``, ``maxBytesPerTrigger``): the lines of one file and trigger meet in one
task, packed to one row per record and Arrow batch before they are shuffled."""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.multiline import CONT, END, START

PIECE_CHARS = 8 << 20
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECORDS = "file string, first_line bigint, last_line bigint, part_no int, n_lines bigint, text string, closed boolean, idle boolean"
_PACKED = "file string, line_num bigint, last_line bigint, n_lines bigint, starts boolean, ends boolean, text string"


def _pack(batches):
    """Consecutive rows of one file and record become one row: START opens a row, END closes one.  Texts are
    slices of the batch's own buffer."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, line = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        state = np.array(batch.column(2).to_pylist(), object)
        starts, ends = state == START, state == END
        new = np.ones(n, bool)
        codes = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new[1:] = (codes[1:] != codes[:-1]) | (line[1:] != line[:-1] + 1) | starts[1:] | ends[:-1]
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [n]])
        texts = batch.column(3).fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1]
        joined = pa.LargeStringArray.from_buffers(len(head), pa.py_buffer(offsets[np.concatenate([head, [n]])].tobytes()), texts.buffers()[2])
        yield pa.RecordBatch.from_arrays([file.take(pa.array(head)), pa.array(line[head], pa.int64()), pa.array(line[tail - 1], pa.int64()),
                                          pa.array(tail - head, pa.int64()), pa.array(starts[head]), pa.array(ends[tail - 1]), joined.cast(pa.string())],
                                         names=["file", "line_num", "last_line", "n_lines", "starts", "ends", "text"])


class OpenRecords(StatefulProcessor):
    """One file's open record."""

    def __init__(self, idle_ms: int, piece_chars: int):
        self.idle_ms, self.piece_chars = idle_ms, piece_chars

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first_line bigint, last_line bigint, n_lines bigint, part_no int, chars bigint")
        self.pieces = handle.getListState("pieces", "text string")

    def _part(self, key, record: dict, texts: list[str], closed: bool, idle: bool) -> tuple:
        return (key[0], record["first_line"], record["last_line"], record["part_no"], record["n_lines"], "".join(texts), closed, idle)

    def _stored(self) -> dict | None:
        if not self.open.exists():
            return None
        return dict(zip(("first_line", "last_line", "n_lines", "part_no", "chars"), self.open.get()))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        lines = pd.concat(list(rows)).sort_values("line_num", kind="stable")
        record, out = self._stored(), []
        fresh: list[str] = []  # text of the open part that is not in state yet
        in_state = record is not None and record["chars"] > 0

        def texts() -> list[str]:
            return ([p[0] for p in self.pieces.get()] if in_state else []) + fresh

        for row in lines.itertuples(index=False):
            if row.starts and record is not None:
                out.append(self._part(key, record, texts(), True, False))
                record = None
            if record is None:
                record = {"first_line": int(row.line_num), "n_lines": 0, "part_no": 0, "chars": 0}
                fresh, in_state = [], False
            record["last_line"] = int(row.last_line)
            record["n_lines"] += int(row.n_lines)
            record["chars"] += len(row.text)
            fresh.append(row.text)
            if row.ends:
                out.append(self._part(key, record, texts(), True, False))
                record = None
            elif record["chars"] >= self.piece_chars:
                out.append(self._part(key, record, texts(), False, False))
                record["part_no"] += 1
                record["chars"] = 0
                fresh, in_state = [], False
        self._store(record, fresh, in_state, timerValues)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RECORDS.split(", ")])

    def _store(self, record: dict | None, fresh: list[str], in_state: bool, timerValues) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if record is None:
            self.pieces.clear()
            self.open.clear()
            return
        text = "".join(fresh)
        if not in_state:
            self.pieces.clear()
        if text:
            self.pieces.appendValue((text,))
        self.open.update(tuple(record[c] for c in ("first_line", "last_line", "n_lines", "part_no", "chars")))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        record = self._stored()
        if record is None:
            return
        out = self._part(key, record, [p[0] for p in self.pieces.get()] if record["chars"] else [], True, True)
        self.pieces.clear()
        self.open.clear()
        yield pd.DataFrame([out], columns=[c.split()[0] for c in RECORDS.split(", ")])

    def close(self) -> None:
        pass


def stream_records(lines: DataFrame, idle_seconds: float = 120.0, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Records of a stream of classified lines: ``RECORDS`` (append mode).

    ``lines``: ``file, line_num, state`` (START, CONT, END; other lines are passed over) and ``text``, what the line
    adds to its record (null: nothing).  A line before any START begins a record of its own, which is known
    by its first line, as in :func:`logweave.operators.multiline.assemble_records`; so does a line that comes
    after its record was flushed.  A file whose name or line number is null has no place and is passed over.
    ``closed``: the record's last part; ``idle``: it was flushed by the timer.  ``n_lines`` and ``last_line`` count the record so
    far.  Start the query inside :func:`state_store`."""
    known = lines.filter(F.col("state").isin(START, CONT, END) & F.col("file").isNotNull() & F.col("line_num").isNotNull())
    packed = known.select("file", F.col("line_num").cast("bigint").alias("line_num"), "state", F.col("text").cast("string").alias("text")).mapInArrow(_pack, _PACKED)
    return packed.groupBy("file").transformWithStateInPandas(OpenRecords(int(idle_seconds * 1000), piece_chars), RECORDS, "append", "ProcessingTime")


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None):
    """For queries started inside: the RocksDB state store, and ``partitions`` of state where given (a query keeps
    the number of its first start).  The session's settings are put back after."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stop_when_taken(query: StreamingQuery, flushed: bool = False, timeout: float = 600.0) -> None:
    """Let a query of :func:`stream_records` take all that is there and, with ``flushed``, until its timers have
    emitted every open record; then stop it.  (A query with timers has always another batch to run, so
    ``availableNow`` does not end it and ``processAllAvailable`` does not return.)"""
    until = time.time() + timeout
    try:
        while True:
            done = query.lastProgress
            if done and done["numInputRows"] == 0 and (not flushed or all(op["numRowsTotal"] == 0 for op in done["stateOperators"])):
                return
            if time.time() > until:
                raise TimeoutError(f"input or open records were left after {timeout} s")
            if query.awaitTermination(0.2):
                raise RuntimeError("the query has ended")
    finally:
        query.stop()


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed
