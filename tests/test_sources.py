"""Reading directories: recursion, name filter, gzip, charsets, exact line numbers over splits."""

import gzip

import pytest
from pyspark.sql import functions as F

from logweave.sources.files import (NoInputFiles, after_offsets, match_regex, read_log_lines, read_manifest,
                                    skip_processed)


def _write_tree(root):
    (root / "a").mkdir()
    (root / "a" / "b").mkdir()
    (root / "one.log").write_text("first\nsecond\n\nfourth")          # last line without newline
    (root / "a" / "two.log").write_text("x1\r\nx2\r\n")               # CRLF
    (root / "a" / "b" / "three.log.gz").write_bytes(gzip.compress(b"g1\ng2\ng3\n"))
    (root / "a" / "skip.txt").write_text("not matched\n")
    (root / "empty.log").write_text("")


def test_match_rule():
    assert match_regex("*") is None
    assert match_regex("*.log") == r"^.*?\.log$"
    assert match_regex(r"access-\d+") == r"^(?:access-\d+)$"


def test_recursive_scan_and_filters(spark, tmp_path):
    _write_tree(tmp_path)
    got = sorted((r.file.rsplit("/", 1)[1], r.line_num, r.line)
                 for r in read_log_lines(spark, str(tmp_path), match="*.log").collect())
    assert got == [("one.log", 1, "first"), ("one.log", 2, "second"), ("one.log", 3, ""), ("one.log", 4, "fourth"),
                   ("two.log", 1, "x1\r"), ("two.log", 2, "x2\r")]
    gz = read_log_lines(spark, str(tmp_path), match=r".*\.gz").collect()
    assert sorted((r.line_num, r.line) for r in gz) == [(1, "g1"), (2, "g2"), (3, "g3")]
    every = read_log_lines(spark, str(tmp_path), match="*")
    assert every.count() == 6 + 3 + 1


def test_missing_dir_and_no_match(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_log_lines(spark, str(tmp_path / "nope"))
    (tmp_path / "x.txt").write_text("a\n")
    with pytest.raises(NoInputFiles):
        read_log_lines(spark, str(tmp_path), match="*.log")


def test_latin1_charset(spark, tmp_path):
    (tmp_path / "l1.log").write_bytes("café crème\nnaïve\n".encode("latin-1"))
    rows = read_log_lines(spark, str(tmp_path), charset="ISO-8859-1").orderBy("line_num").collect()
    assert [r.line for r in rows] == ["café crème", "naïve"]


def test_utf16_whole_file_path(spark, tmp_path):
    (tmp_path / "w.log").write_bytes("été\nhiver\n".encode("utf-16-le"))
    rows = read_log_lines(spark, str(tmp_path), charset="UTF-16LE").orderBy("line_num").collect()
    assert [(r.line_num, r.line) for r in rows] == [(1, "été"), (2, "hiver")]


def test_line_numbers_exact_over_many_splits(spark, tmp_path):
    """Split invariance: 200-byte splits give the same numbered table as one split per file."""
    for k in range(3):
        (tmp_path / f"f{k}.log").write_text("".join(f"file {k} line {i:05d}\n" for i in range(1, 2001)))
    (tmp_path / "z.log.gz").write_bytes(gzip.compress("".join(f"gz {i}\n" for i in range(1, 501)).encode()))
    expected = {(f"f{k}.log", i, f"file {k} line {i:05d}") for k in range(3) for i in range(1, 2001)}
    expected |= {("z.log.gz", i, f"gz {i}") for i in range(1, 501)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = read_log_lines(spark, str(tmp_path), match=r".*\.log(\.gz)?")
            got = {(r.file.rsplit("/", 1)[1], r.line_num, r.line) for r in df.collect()}
            assert got == expected, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_numbers_with_shuffle_join(spark, tmp_path):
    """Beyond the broadcast limit the split table is joined by a shuffle join: same result."""
    (tmp_path / "a.log").write_text("".join(f"{i}\n" for i in range(1, 301)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        df = read_log_lines(spark, str(tmp_path), broadcast_rows=0)
        assert all(int(r.line) == r.line_num for r in df.collect())
        assert df.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_manifest_and_offsets(spark, tmp_path):
    _write_tree(tmp_path)
    all_lines = read_log_lines(spark, str(tmp_path), match="*.log")
    one = [r.file for r in all_lines.select("file").distinct().collect() if r.file.endswith("one.log")][0]
    man = tmp_path / "manifest.txt"
    man.write_text(f"  {one}  \n\n")
    kept = read_log_lines(spark, str(tmp_path), match="*.log", processed=read_manifest(spark, str(man)))
    assert {r.file.rsplit("/", 1)[1] for r in kept.select("file").distinct().collect()} == {"two.log"}
    offs = spark.createDataFrame([(one, 2)], "file string, last_line bigint")
    rest = after_offsets(all_lines, offs)
    assert sorted((r.file.rsplit("/", 1)[1], r.line_num) for r in rest.collect()) == [
        ("one.log", 3), ("one.log", 4), ("two.log", 1), ("two.log", 2)]
    kept2 = skip_processed(all_lines, spark.createDataFrame([(one,)], "file string"))
    assert kept2.where(F.col("file") == one).count() == 0


def test_regex_line_delimiter(spark, tmp_path):
    (tmp_path / "r.log").write_text("a;;b;c;;;d")
    rows = read_log_lines(spark, str(tmp_path), line_sep_regex=";+").orderBy("line_num").collect()
    assert [(r.line_num, r.line) for r in rows] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_paths_with_special_characters(spark, tmp_path):
    d = tmp_path / "dir a b" / "x%y"
    d.mkdir(parents=True)
    (d / "f +1.log").write_text("l1\nl2\n")
    files = {r.file for r in read_log_lines(spark, str(tmp_path)).select("file").distinct().collect()}
    assert files == {str(d / "f +1.log")}
    man = tmp_path / "m.txt"
    man.write_text(str(d / "f +1.log") + "\n")
    (tmp_path / "other.log").write_text("o\n")
    kept = read_log_lines(spark, str(tmp_path), processed=read_manifest(spark, str(man)))
    assert [r.line for r in kept.collect()] == ["o"]
