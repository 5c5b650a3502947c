"""Open records in streaming state (T3)."""

import time

import pyarrow as pa
import pytest

from logweave.streaming.records import _pack, state_store, stop_when_taken, stream_records

LINES = "file string, line_num bigint, state string, text string"


class Stream:
    def __init__(self, spark, base, **options):
        self.spark, self.base, self.options = spark, base, options

    def put(self, *rows):
        self.spark.createDataFrame(rows, LINES).coalesce(2).write.mode("append").parquet(f"{self.base}/in")

    def start(self, **options):
        lines = self.spark.readStream.schema(LINES).parquet(f"{self.base}/in")
        with state_store(self.spark, 2):
            return stream_records(lines, **{**self.options, **options}).writeStream.format("parquet").option(
                "checkpointLocation", f"{self.base}/check").trigger(processingTime="100 milliseconds").start(f"{self.base}/out")

    def take(self, **options):
        """Take what is there, then stop: a restart follows."""
        stop_when_taken(self.start(**options), timeout=90)

    def out(self):
        rows = self.spark.read.parquet(f"{self.base}/out").collect()
        return sorted((r.file, r.first_line, r.part_no, r.last_line, r.n_lines, r.text, r.closed, r.idle) for r in rows)


def test_records_over_restarts(spark, tmp_path):
    s = Stream(spark, str(tmp_path), idle_seconds=3600)
    s.put(("a", 2, "CONT", " two"), ("a", 1, "START", "one"), ("b", 1, "CONT", "orphan"), ("a", 3, "START", "three"), ("a", 4, "SKIP", "no"), (None, 1, "START", "x"))
    s.take()
    assert s.out() == [("a", 1, 0, 2, 2, "one two", True, False)]
    s.put(("a", 5, "CONT", None), ("a", 6, "CONT", " four"), ("b", 2, "END", " end"), ("b", 3, "START", "open"), ("c", 9, "START", "alone"))
    s.take()
    assert s.out()[1:] == [("b", 1, 0, 2, 2, "orphan end", True, False)]
    s.put(("a", 7, "CONT", " five"), ("b", 4, "CONT", " last"), ("c", 10, "START", "c"), ("c", 11, "END", "!"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stop_when_taken(s.start(idle_seconds=1), flushed=True, timeout=90)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert s.out() == [("a", 1, 0, 2, 2, "one two", True, False), ("a", 3, 0, 7, 4, "three four five", True, True), ("b", 1, 0, 2, 2, "orphan end", True, False),
                       ("b", 3, 0, 4, 2, "open last", True, True), ("c", 9, 0, 9, 1, "alone", True, False), ("c", 10, 0, 11, 2, "c!", True, False)]


def test_long_record_leaves_in_parts(spark, tmp_path):
    s = Stream(spark, str(tmp_path), idle_seconds=3600, piece_chars=40)
    s.put(("a", 1, "START", "head"), *[("a", i, "CONT", f" {i:08d}") for i in range(2, 30)])
    s.take()
    s.put(*[("a", i, "CONT", f" {i:08d}") for i in range(30, 33)])
    stop_when_taken(s.start(idle_seconds=1), flushed=True, timeout=90)
    parts = s.out()
    assert [p[2] for p in parts] == list(range(len(parts))) and len(parts) > 1 and {p[1] for p in parts} == {1}
    assert [p[6] for p in parts] == [False] * (len(parts) - 1) + [True] and parts[-1][4] == 32
    assert "".join(p[5] for p in parts) == "head" + "".join(f" {i:08d}" for i in range(2, 33))


def test_pack():
    batch = pa.RecordBatch.from_pylist([{"file": f, "line_num": n, "state": s, "text": t} for f, n, s, t in [
        ("a", 1, "CONT", "x"), ("a", 2, "CONT", None), ("a", 3, "START", "é"), ("a", 4, "CONT", "y"), ("a", 6, "CONT", "z"), ("a", 7, "END", "!"), ("a", 8, "CONT", "w"), ("b", 9, "CONT", "v")]],
        schema=pa.schema([("file", pa.string()), ("line_num", pa.int64()), ("state", pa.string()), ("text", pa.string())]))
    (got,) = _pack([batch])
    assert [tuple(r.values()) for r in got.to_pylist()] == [("a", 1, 2, 2, False, False, "x"), ("a", 3, 4, 2, True, False, "éy"), ("a", 6, 7, 2, False, True, "z!"),
                                                          ("a", 8, 8, 1, False, False, "w"), ("b", 9, 9, 1, False, False, "v")]
    assert [r["text"] for r in next(_pack([batch.slice(2, 3)])).to_pylist()] == ["éy", "z"]


def test_ended_query_is_told(spark, tmp_path):
    s = Stream(spark, str(tmp_path), idle_seconds=3600)
    s.put(("a", 1, "START", "one"))
    began = time.time()
    with pytest.raises(TimeoutError):
        stop_when_taken(s.start(), flushed=True, timeout=1)
    assert time.time() - began < 120
