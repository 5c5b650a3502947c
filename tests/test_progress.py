"""Progress as a table (A4)."""

import time

import pytest
from pyspark.sql import functions as F

from logweave.operators.extract import json_lines
from logweave.operators.multiline import xml_field_docs
from logweave.operators.normalize import normalize_lines
from logweave.operators.stats import file_stats, run_counts, run_stats, status_of
from logweave.plans.jobs import index_directory
from logweave.sources.files import read_log_lines, read_manifest
from logweave.streaming.progress import ProgressListener, ProgressLog, read_progress


def test_directory_in_groups(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(23):
        (src / f"{i}.log").write_text("".join(f'{{"a": {k}}}\n' if (i + k) % 4 else ("\n" if k % 2 else "broken\n") for k in range(i)))
    log = ProgressLog(str(tmp_path / "progress"), every_files=5, every_seconds=1e9, job="first")
    out, manifest = str(tmp_path / "out"), str(tmp_path / "done")
    parse = lambda lines: json_lines(lines).where("_matched")
    counts = index_directory(spark, str(src), parse, manifest=manifest, write_to=out, files_per_pass=4, progress=log)
    rows = read_progress(spark, str(tmp_path / "progress")).orderBy("seq").collect()
    assert 3 <= len(rows) <= 7 and [r.final for r in rows] == [False] * (len(rows) - 1) + [True]
    parsed = json_lines(normalize_lines(read_log_lines(spark, str(src)), keep_blank=True))
    want = run_stats(file_stats(status_of(parsed))).first()
    last = rows[-1]
    assert (last.lines_read, last.lines_parsed, last.lines_skipped, last.docs) == (want.lines_read, want.lines_parsed, want.lines_skipped, want.docs)
    assert last.files == 22 == read_manifest(spark, manifest).count() and all(a.lines_read <= b.lines_read for a, b in zip(rows, rows[1:]))
    assert counts.agg(F.sum("docs")).first()[0] == want.docs
    index_directory(spark, str(src), parse, manifest=manifest, write_to=out, files_per_pass=4)
    assert spark.read.parquet(out).count() == want.docs
    with pytest.raises(ValueError):
        index_directory(spark, str(src), parse, write_to=out, files_per_pass=4)


def test_multiline_job(spark, tmp_path):
    from conftest import DATA
    import shutil

    src = tmp_path / "in"
    src.mkdir()
    shutil.copy(f"{DATA}/people.xml", src / "a.xml")
    log = ProgressLog(str(tmp_path / "p"))
    index_directory(spark, str(src), xml_field_docs, match="*.xml", manifest=str(tmp_path / "m"), write_to=str(tmp_path / "o"), progress=log)
    last = read_progress(spark, str(tmp_path / "p")).filter("final").first()
    assert (last.files, last.lines_read, last.lines_parsed, last.lines_skipped, last.docs) == (1, 44, 42, 2, 6)


def test_stream(spark, tmp_path):
    lines = [("f%d" % (i // 40), i % 40 + 1, "" if i % 7 == 0 else "1.2.3.4 - - [x] bad" if i % 3 else "word 5") for i in range(200)]
    df = spark.createDataFrame(lines, "file string, line_num bigint, line string")
    for k in range(3):
        df.filter(F.col("line_num") % 3 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))

    def job(d):
        return status_of(normalize_lines(d, keep_blank=True).withColumn("_matched", F.col("line").startswith("word")))

    log = ProgressLog(str(tmp_path / "p"), every_files=2, every_seconds=1e9)
    listener = ProgressListener(log, "mine")
    spark.streams.addListener(listener)
    try:
        q = job(stream).observe("mine", *run_counts()).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        want = job(df).agg(*run_counts()).first().asDict()
        until = time.time() + 30
        while log.totals["lines_read"] < 200 and time.time() < until:
            time.sleep(0.2)  # listeners are told a little later
    finally:
        spark.streams.removeListener(listener)
    log.close()
    rows = read_progress(spark, str(tmp_path / "p")).orderBy("seq").collect()
    assert len(rows) >= 2 and {c: rows[-1][c] for c in want} == want and want["files"] == 5


def test_report_does_not_stop_a_job(tmp_path):
    log = ProgressLog("nowhere://x/y", every_files=1)
    with pytest.warns(UserWarning, match="not written"):
        log.add(files=1)
    with pytest.raises(ValueError):
        log.add(pages=1)
