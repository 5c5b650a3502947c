"""Batches, delivery with a fake client, manifest, directory watching, tailing and idle flush."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from logweave.operators.documents import to_documents
from logweave.operators.extract import raw_lines
from logweave.operators.multiline import CONT, START
from logweave.operators.normalize import normalize_lines
from logweave.operators.stats import endpoint_stats
from logweave.sinks.batches import batch_documents, batch_documents_by_key
from logweave.sinks.deliver import DeliveryError, deliver, update_manifest, write_documents
from logweave.sources.files import read_manifest
from logweave.streaming.tail import tail_once
from logweave.streaming.watch import watch_directory


def _docs(spark, n, parts):
    recs = spark.range(n).repartition(parts).select(F.lit("f").alias("file"), (F.col("id") + 1).alias("line_num"),
                                                     F.col("id").cast("string").alias("v"))
    return to_documents(recs)


def test_batches_per_partition(spark):
    b = batch_documents(_docs(spark, 1050, 3), n=100).collect()
    assert sum(r.n_docs for r in b) == 1050
    assert all(r.n_docs <= 100 for r in b)
    per_part = {}
    for r in b:
        per_part.setdefault(r.batch_id.split("-")[0], []).append(r.n_docs)
    assert all(sum(1 for x in v if x < 100) <= 1 for v in per_part.values())  # one short batch per partition
    docs = json.loads(b[0].payload)
    assert isinstance(docs, list) and {"id", "fields"} <= set(docs[0])


def test_batches_by_key_deterministic(spark):
    recs = spark.range(1000).select(F.lit("f").alias("file"), F.col("id").alias("line_num"),
                                    F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("k"))
    docs = to_documents(recs).join(recs.select("id", "k", F.col("line_num").alias("o")), "id")
    b = batch_documents_by_key(docs, "k", "o", n=100, chunk_width=64).orderBy("k", "batch_no").collect()
    sizes = [(r.k, r.batch_no, r.n_docs, r.first_order) for r in b]
    assert sizes[:4] == [(0, 0, 100, 0), (0, 1, 100, 300), (0, 2, 100, 600), (0, 3, 34, 900)]
    assert sum(r.n_docs for r in b) == 1000


def fake_client(log_dir):
    """post(endpoint, payload) -> status; endpoint 'down' always fails.  A closure, so it is
    shipped to the Python workers by value."""
    def post(endpoint, payload):
        import os as _os
        import time as _time
        if endpoint == "down":
            return 503
        with open(_os.path.join(log_dir, f"{endpoint}-{_os.getpid()}-{_time.time_ns()}.json"), "w") as fh:
            fh.write(payload)
        return 200
    return post


def test_deliver_with_failover(spark, tmp_path):
    log = deliver(_docs(spark, 350, 2), ["down", "ok1"], fake_client(str(tmp_path)), batch_size=100,
                  retry_wait_s=0.0, seed=1)
    rows = log.collect()
    assert sum(r.n_docs for r in rows) == 350 and {r.endpoint for r in rows} == {"ok1"}
    sent = sum(len(json.load(open(tmp_path / f))) for f in os.listdir(tmp_path))
    assert sent == 350
    st = endpoint_stats(log).collect()
    assert [(r.endpoint, r.docs_sent) for r in st] == [("ok1", 350)]


def test_deliver_fails_when_all_down(spark, tmp_path):
    with pytest.raises(Exception, match="could not be delivered"):
        deliver(_docs(spark, 10, 1), ["down"], fake_client(str(tmp_path)), retry_wait_s=0.0).collect()


def test_write_and_manifest(spark, tmp_path):
    docs = _docs(spark, 20, 2)
    write_documents(docs, str(tmp_path / "out"), mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    update_manifest(docs, str(tmp_path / "manifest"))
    assert [r.file for r in read_manifest(spark, str(tmp_path / "manifest")).collect()] == ["f"]


def test_watch_directory_each_file_once(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.log").write_text("a1\na2\n")
    ckpt = str(tmp_path / "ckpt")

    def handler(lines, batch_id):
        raw_lines(normalize_lines(lines)).write.mode("append").parquet(str(out))

    q = watch_directory(spark, str(src), handler, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)
    (src / "sub").mkdir()
    (src / "sub" / "b.log").write_text("b1\n\nb3")
    (src / "skip.txt").write_text("x\n")
    q = watch_directory(spark, str(src), handler, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)
    got = sorted((r.id.rsplit("/", 1)[1], r._raw_content_) for r in spark.read.parquet(str(out)).collect())
    assert got == [("a.log:1", "a1"), ("a.log:2", "a2"), ("b.log:1", "b1"), ("b.log:3", "b3")]


def test_tail_single_line(spark, tmp_path):
    src = tmp_path / "logs"
    src.mkdir()
    f = src / "app.log"
    f.write_text("l1\nl2\npart")
    state = str(tmp_path / "state")
    seen = []

    def handler(df):
        seen.extend(sorted((r.line_num, r.line) for r in df.collect()))

    tail_once(spark, str(src), handler, state)
    assert seen == [(1, "l1"), (2, "l2")]           # the partly written line waits
    with open(f, "a") as fh:
        fh.write("ial\nl4\n")
    tail_once(spark, str(src), handler, state)
    assert seen == [(1, "l1"), (2, "l2"), (3, "partial"), (4, "l4")]
    tail_once(spark, str(src), handler, state)      # nothing new
    assert len(seen) == 4


def test_tail_multiline_hold_back_and_idle_flush(spark, tmp_path):
    src = tmp_path / "logs"
    src.mkdir()
    f = src / "app.log"
    f.write_text("START a\ncont\nSTART b\ncont b\n")
    state = str(tmp_path / "state")
    seen = []

    def classify(lines):
        return lines.withColumn("state", F.when(F.col("line").startswith("START"), F.lit(START)).otherwise(F.lit(CONT)))

    def handler(df):
        seen.extend(sorted(r.line_num for r in df.collect()))

    tail_once(spark, str(src), handler, state, classify=classify, idle_seconds=3600)
    assert seen == [1, 2]                            # record b is still open
    with open(f, "a") as fh:
        fh.write("more b\n")
    tail_once(spark, str(src), handler, state, classify=classify, idle_seconds=3600)
    assert seen == [1, 2]
    tail_once(spark, str(src), handler, state, classify=classify, idle_seconds=0)   # idle: flush
    assert seen == [1, 2, 3, 4, 5]


def test_index_directory_end_to_end(spark, tmp_path):
    import shutil
    from logweave.operators.multiline import xml_field_docs
    from logweave.plans.jobs import index_directory
    from conftest import DATA
    src = tmp_path / "in"
    src.mkdir()
    shutil.copy(os.path.join(DATA, "people.xml"), src / "a.xml")
    out, man = str(tmp_path / "docs"), str(tmp_path / "manifest")
    stats = index_directory(spark, str(src), xml_field_docs, match="*.xml", manifest=man, write_to=out)
    assert [r.docs for r in stats.collect()] == [6]
    # second pass: the file is in the manifest, nothing new is read
    shutil.copy(os.path.join(DATA, "people.xml"), src / "b.xml")
    index_directory(spark, str(src), xml_field_docs, match="*.xml", manifest=man, write_to=out)
    docs = spark.read.parquet(out)
    assert docs.count() == 12 and docs.select("id").distinct().count() == 6
    assert sorted(r.file.rsplit("/", 1)[1] for r in read_manifest(spark, man).collect()) == ["a.xml", "b.xml"]
    # a pass with every file processed reads nothing and is not an error
    index_directory(spark, str(src), xml_field_docs, match="*.xml", manifest=man, write_to=out)
    assert spark.read.parquet(out).count() == 12
