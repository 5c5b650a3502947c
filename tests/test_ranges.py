"""Byte ranges: lines at any cut, the line index, file identity in tails."""

import gzip
import io
import os
import shutil
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logweave.operators.multiline import CONT, START
from logweave.sources import ranges
from logweave.sources.files import list_sources, read_log_lines
from logweave.streaming.tail import tail_once


def cells(data, cut, size=None):
    size = len(data) if size is None else size
    rows = [{"file": "f", "uri": "f", "start": s, "stop": s + cut, "size": size} for s in range(0, max(size, 1), cut)]
    return rows


def read_all(data, charset, sep, cut, uri="f", size=None):
    def opener(_):
        return io.BytesIO(data)

    rows = cells(data, cut, size) if not uri.endswith(".gz") else [{"start": 0, "stop": 1 << 62, "size": len(data)}]
    out, before = [], 0
    for row in rows:
        row.update(file="f", uri=uri)
        (count,) = [b.to_pylist()[0] for b in ranges._count(charset, sep, opener)([pa.RecordBatch.from_pylist([row])])]
        assert count["start"] == row["start"]
        read = {**row, "before": before, "after": 0, "last": 1 << 62}
        got = [r for b in ranges._read(charset, sep, opener)([pa.RecordBatch.from_pylist([read])]) for r in b.to_pylist()]
        assert len(got) == count["n"]
        before += count["n"]
        out += got
    assert [r["line_num"] for r in out] == list(range(1, len(out) + 1))
    return out


@pytest.mark.parametrize("charset,mark", [("utf-8", b""), ("utf-8", b"\xef\xbb\xbf"), ("latin-1", b""), ("utf-16-le", b""), ("utf-16", b"\xff\xfe"),
                                          ("utf-16", b"\xfe\xff"), ("UTF-16", b""), ("utf-32", b"\xff\xfe\x00\x00"), ("utf-32-be", b""), ("gbk", b"")])
def test_lines_at_any_cut(monkeypatch, charset, mark):
    rng = np.random.default_rng(len(charset) + len(mark))
    real = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be", b"\xff\xfe\x00\x00": "utf-32-le", b"\xef\xbb\xbf": "utf-8"}.get(mark, "utf-16-be" if charset == "UTF-16" else charset)
    signs = list("ab\n\nx\r") + (["é"] if charset != "gbk" else ["中"]) + (["ਊ", "਀", "\U0001F600"] if real.startswith("utf") else [])
    for k in range(60):
        for sep in ("\n",) + (("\r\n", "aba", "\n\n", "é") if real.startswith("utf") else ()):
            text = "".join(rng.choice(signs, int(rng.integers(0, 60))))
            data = mark + text.encode(real)
            monkeypatch.setattr(ranges, "BLOCK_BYTES", int(rng.choice([4, 8, 12, 64])))
            whole = ranges._overlaps_itself(sep.encode(real))
            got = read_all(data, charset, sep, 1 << 30 if whole else int(rng.choice([4, 8, 20])))
            want = text.split(sep)
            want = want[:-1] if want[-1] == "" else want
            assert [r["line"] for r in got] == want, (text, sep)
            for r, w in zip(got, want):
                assert data[r["pos"]:].startswith(w.encode(real))


def test_gzip_streams_members(monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK_BYTES", 16)
    text = "".join(f"line {i} é\n" for i in range(500)) + "last"
    data = text.encode("utf-16")
    packed = gzip.compress(data[:777]) + gzip.compress(data[777:])
    assert [r["line"] for r in read_all(packed, "utf-16", "\n", 4, uri="f.gz")] == text.split("\n")


def test_bytes_that_are_no_text():
    got = read_all(b"ok\n\xff\xfe bad\nend", "utf-8", "\n", 4)
    assert [r["line"] for r in got] == ["ok", "�� bad", "end"]


def test_charsets():
    assert all(ranges.supported(c, "\n") for c in ("UTF-8", "UTF-16", "UTF-32LE", "ISO-8859-1", "windows-1252", "Shift_JIS"))
    assert not ranges.supported("no-such-charset", "\n") and not ranges.supported("gbk", "ab") and not ranges.supported("utf-8", "")


def logged_opener(folder):
    """Opens local files and writes down what is read of them."""
    def opener(uri):
        import os
        import uuid

        f = open(uri.removeprefix("file://").removeprefix("file:"), "rb")

        class Logged:
            def read(self, n=-1):
                at = f.tell()
                data = f.read(n)
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as note:
                    note.write(f"{uri}|{at}|{len(data)}")
                return data

            def seek(self, at):
                return f.seek(at)

            def close(self):
                f.close()

        return Logged()

    return opener


def reads(folder):
    """(file name, position, bytes) since the last call."""
    out = []
    for name in os.listdir(folder):
        uri, at, n = open(os.path.join(folder, name)).read().split("|")
        out.append((uri.rsplit("/", 1)[1], int(at), int(n)))
        os.remove(os.path.join(folder, name))
    return out


def numbered(lines):
    return sorted((r.file.rsplit("/", 1)[1], r.line_num, r.line) for r in lines.collect())


def test_line_index(spark, tmp_path, monkeypatch):
    src, notes, index = tmp_path / "in", tmp_path / "notes", str(tmp_path / "index")
    src.mkdir()
    notes.mkdir()
    opener = logged_opener(str(notes))
    want = {}

    def put(name, lines, end="\n"):
        want[name] = lines
        (src / name).write_text("\n".join(lines) + end)

    def check(**more):
        got = numbered(read_log_lines(spark, str(src), index_dir=index, opener=opener, **more))
        assert got == sorted((name, i, line) for name, lines in want.items() for i, line in enumerate(lines, 1))

    put("a.log", [f"a {i}" for i in range(3000)])
    put("b.log", [f"b {i}" for i in range(50)], end="")
    put("empty.log", [], end="")
    check()
    first = sum(n for _, _, n in reads(notes))
    check()
    again = reads(notes)
    size = sum(os.path.getsize(src / n) for n in want)
    assert sum(n for _, _, n in again) <= size + 16 and first >= 2 * size  # one pass when nothing has changed
    time.sleep(0.01)
    put("a.log", want["a.log"] + ["grown"])
    put("b.log", ["other"] * 60)
    put("c.log", ["new"])
    check()
    assert read_log_lines(spark, str(src), index_dir=index).count() == 3000 + 1 + 60 + 1


def test_index_keeps_cells_before_the_end(spark, tmp_path):
    src, notes, index = tmp_path / "in", tmp_path / "notes", str(tmp_path / "index")
    src.mkdir()
    notes.mkdir()
    (src / "a.log").write_text("".join(f"row {i:06d}\n" for i in range(20000)))
    opener = logged_opener(str(notes))
    for step in range(3):
        files = list_sources(spark, str(src))
        rows = ranges.update_index(spark, files, index, cell_bytes=1 << 14, opener=opener).orderBy("start").collect()
        done, seen = reads(notes), 0
        for r in rows:
            assert r.before == seen
            seen += r.n
        assert seen == 20000 + 1000 * step
        if step:
            assert min(at for _, at, n in done if n > ranges.PRINT_BYTES) >= (20000 + 1000 * (step - 1)) * 11 // (1 << 14) * (1 << 14) - 4
        with open(src / "a.log", "a") as f:
            f.write("".join(f"new {i:06d}\n" for i in range(1000)))
        time.sleep(0.01)


def test_offsets_seek(spark, tmp_path, monkeypatch):
    notes = tmp_path / "notes"
    notes.mkdir()
    (tmp_path / "a.log").write_text("".join(f"row {i:06d}\n" for i in range(200000)))
    name = str(tmp_path / "a.log")
    index = str(tmp_path / "index")
    files = list_sources(spark, str(tmp_path))
    ranges.update_index(spark, files, index, cell_bytes=1 << 16)
    offsets = spark.createDataFrame([(name, 190000)], "file string, last_line bigint")
    got = read_log_lines(spark, str(tmp_path), index_dir=index, offsets=offsets, opener=logged_opener(str(notes)))
    assert got.count() == 10000 and got.agg(F.min("line_num")).first()[0] == 190001
    assert min(at for _, at, n in reads(notes) if n > ranges.PRINT_BYTES) > 190000 * 11 - (1 << 16) - 16


def test_large_manifest_opens_no_listed_file(spark, tmp_path):
    src, notes = tmp_path / "in", tmp_path / "notes"
    src.mkdir()
    notes.mkdir()
    for i in range(30):
        (src / f"{i}.log").write_text(f"line {i}\n")
    listed = spark.range(50000).select(F.concat(F.lit(f"{src}/"), F.when(F.col("id") < 25, F.col("id")).otherwise(F.col("id") + 1000), F.lit(".log")).alias("file"))
    got = numbered(read_log_lines(spark, str(src), processed=listed, opener=logged_opener(str(notes))))
    assert got == sorted((f"{i}.log", 1, f"line {i}") for i in range(25, 30))
    assert {f for f, _, _ in reads(notes)} == {f"{i}.log" for i in range(25, 30)}


class Tail:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.src, self.state, self.options = spark, tmp_path / "logs", str(tmp_path / "state"), options
        self.src.mkdir()
        self.seen = []

    def put(self, name, text, mode="w"):
        time.sleep(0.01)
        with open(self.src / name, mode) as f:
            f.write(text)

    def run(self, **more):
        got = []
        tail_once(self.spark, str(self.src), lambda df: got.extend(numbered(df)), self.state, **{**self.options, **more})
        return [(f, n, line) for f, n, line in got]


def test_replaced_files(spark, tmp_path):
    t = Tail(spark, tmp_path)
    t.put("a.log", "old1\nold2\nold3\n")
    t.put("b.log", "b1\nb2\n")
    assert len(t.run()) == 5
    t.put("a.log", "new1\nnew2\nnew3\nnew4\n")  # longer
    t.put("b.log", "c1\nc2\n")  # as long
    assert t.run() == [("a.log", i, f"new{i}") for i in range(1, 5)] + [("b.log", 1, "c1"), ("b.log", 2, "c2")]
    t.put("a.log", "x\n")  # shorter
    assert t.run() == [("a.log", 1, "x")]
    assert t.run() == []


def test_renamed_files(spark, tmp_path):
    t = Tail(spark, tmp_path, match=r".*\.log(\.\d+)?")
    t.put("a.log", "one\ntwo\n")
    assert len(t.run()) == 2
    t.put("a.log", "three\n", "a")  # written before the rotation, not seen yet
    os.rename(t.src / "a.log", t.src / "a.log.1")
    t.put("a.log", "four\n")
    assert t.run() == [("a.log", 1, "four"), ("a.log.1", 3, "three")]
    os.rename(t.src / "a.log.1", t.src / "a.log.2")
    os.rename(t.src / "a.log", t.src / "a.log.1")
    t.put("a.log", "five\n")
    assert t.run() == [("a.log", 1, "five")]
    shutil.copy(t.src / "a.log", t.src / "a.log.3")  # copied, then cut
    t.put("a.log", "")
    assert t.run() == []
    t.put("a.log", "six\n", "a")
    assert t.run() == [("a.log", 1, "six")]


def test_copy_of_a_followed_file_is_a_file(spark, tmp_path):
    t = Tail(spark, tmp_path)
    t.put("a.log", "one\n")
    t.run()
    shutil.copy(t.src / "a.log", t.src / "b.log")
    assert t.run() == [("b.log", 1, "one")]


def test_tail_reads_only_what_is_new(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    t = Tail(spark, tmp_path, opener=logged_opener(str(notes)))
    t.put("a.log", "".join(f"row {i:06d}\n" for i in range(100000)))
    assert len(t.run()) == 100000
    reads(notes)
    t.put("a.log", "more\npart", "a")
    assert t.run() == [("a.log", 100001, "more")]
    assert max(n for _, _, n in reads(notes)) <= ranges.PRINT_BYTES
    t.put("a.log", "ly\n", "a")
    assert t.run() == [("a.log", 100002, "partly")]


@pytest.mark.parametrize("charset", ["UTF-16", "UTF-16LE", "ISO-8859-1", "UTF-32"])
def test_tail_charsets(spark, tmp_path, charset):
    t = Tail(spark, tmp_path, charset=charset)
    kind = {"UTF-16": "utf-16-be", "UTF-32": "utf-32-be"}.get(charset, charset)
    t.src.joinpath("a.log").write_bytes("é1\né2\nopen".encode(kind))
    assert t.run() == [("a.log", 1, "é1"), ("a.log", 2, "é2")]
    time.sleep(0.01)
    with open(t.src / "a.log", "ab") as f:
        f.write(" é3\n".encode(kind))
    assert t.run() == [("a.log", 3, "open é3")]
    with pytest.raises(ValueError, match="cannot be found"):
        t.run(charset="no-such-charset")


def test_open_record_is_read_from_its_start(spark, tmp_path):
    seen = []

    def classify(lines):
        seen.append(lines.count())
        return lines.withColumn("state", F.when(F.col("line").startswith("START"), F.lit(START)).otherwise(F.lit(CONT)))

    t = Tail(spark, tmp_path, classify=classify, idle_seconds=3600)
    t.put("a.log", "START a\n" + "cont\n" * 500 + "START b\ncont b\n")
    assert len(t.run()) == 501
    t.put("a.log", "more b\n", "a")
    assert t.run() == [] and seen[-1] == 3
    assert t.run(idle_seconds=0) == [("a.log", 502, "START b"), ("a.log", 503, "cont b"), ("a.log", 504, "more b")]


def test_failed_run_is_repeated(spark, tmp_path):
    t = Tail(spark, tmp_path)
    t.put("a.log", "one\n")

    def fail(df):
        raise RuntimeError("sink")

    with pytest.raises(RuntimeError):
        tail_once(spark, str(t.src), fail, t.state)
    assert t.run() == [("a.log", 1, "one")]
