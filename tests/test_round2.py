"""Cases in which lines, fields or records were once lost."""

import gzip

import pytest
from pyspark.sql import functions as F

from logweave.functions.grok import compile_grok, required_literals
from logweave.operators.ordering import chunked_row_number
from logweave.operators.solr import explode_params, solr_log
from logweave.sinks.batches import batch_documents_by_key
from logweave.sinks.deliver import deliver
from logweave.operators.documents import to_documents
from logweave.operators.stats import endpoint_stats
from logweave.session import scratch_path
from logweave.sources.files import list_files, read_log_lines, read_manifest, release_split_tables


@pytest.fixture
def big_file(tmp_path):
    with open(tmp_path / "big.log", "w") as f:
        for i in range(60000):
            f.write(f"line {i + 1} {'x' * (i % 50)}\n")
    return str(tmp_path)


def test_more_cores_between_count_and_use(spark, big_file):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    spark.conf.set("spark.sql.files.openCostInBytes", "10k")
    try:
        lines = read_log_lines(spark, big_file)
        assert lines.count() == 60000
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")  # as if executors had joined
        got = lines.select("line_num", F.split("line", " ")[1].cast("long").alias("n"))
        assert got.count() == 60000 and got.filter("line_num <> n").count() == 0
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_changed_splits_are_an_error(spark, big_file):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = read_log_lines(spark, big_file)
    assert lines.count() == 60000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        with pytest.raises(Exception, match="splits changed"):
            read_log_lines_again = lines.select("line_num", "line").filter("line_num > 0")
            read_log_lines_again.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_split_tables_are_released(spark, big_file):
    release_split_tables(spark)
    for _ in range(3):
        read_log_lines(spark, big_file).count()
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent()
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = lambda: [s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().startswith("splits-")]
    assert len(left()) >= 3
    before = set(left())
    assert release_split_tables(spark) == 3
    assert len(before - set(left())) == 3


@pytest.mark.parametrize("rx,lines", [
    (r"(?<w>\p{Lu}\p{L}+) %{INT:x}", ["Émile 5", "Abc 7"]), (r"\x41%{INT:x}", ["A5"]), (r"\x{1F600}%{INT:x}", ["😀5"]), ("\\" + "u0041b%{INT:x}", ["Ab3"]),
    (r"\0101b%{INT:x}", ["Ab3"]), (r"\PL%{INT:x}", ["#3"]), (r"\P{Lu}%{INT:x}", ["a3"]), (r"\cA%{INT:x}", ["\x013"]),
    (r"\tq\R%{INT:x}", ["\tq\n3"]), (r"\Qp{L}\E%{INT:x}", ["p{L}5"]), (r"\.log\-%{INT:x}", [".log-5"])])
def test_escapes_are_not_literal_text(spark, rx, lines):
    got = compile_grok(rx).apply(spark.createDataFrame([(s,) for s in lines], "line string")).collect()
    assert all(r._matched and r.x for r in got)


def test_literals_around_escapes():
    assert required_literals(r"abc\p{L}def") == ["abc", "def"]
    assert required_literals("ab\\x41\\x{42}cd\\" + "u0043ef\\0101gh") == ["ab", "cd", "ef"]
    assert required_literals(r"foo\cAbar") == [] and required_literals(r"foo\yzz") == []
    assert required_literals(r"(?<n>a)\k<n>tail") == ["tail", "a"]


def test_null_keys_and_orders_are_kept(spark):
    rows = [("a", 1), ("a", None), (None, 2), (None, 1), ("a", 70000), ("b", None)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = {(r.k, r.o): r.rn for r in chunked_row_number(df, ["k"], "o", chunk_width=100).collect()}
    assert got == {("a", None): 1, ("a", 1): 2, ("a", 70000): 3, (None, 1): 1, (None, 2): 2, ("b", None): 1}
    docs = to_documents(df.select(F.lit("f").alias("file"), F.monotonically_increasing_id().alias("line_num"), "k", "o"), keep=["k", "o"])
    assert sum(r.n_docs for r in batch_documents_by_key(docs, "k", "o", n=2).collect()) == len(rows)


def test_pair_without_sign_replaces_nothing(spark):
    texts = ["a_s=1&a_s", "x=1&y=2&x_s", "a&b&c=1", "a", "", "&&x=1&", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string").select("i", explode_params(F.col("p")).alias("m")).collect()
    assert {r.i: r.m for r in got} == {0: {"a_s": "1"}, 1: {"x_s": "1", "y_s": "2"}, 2: {"c_s": "1"}, 3: {}, 4: {}, 5: {"x_s": "1"}, 6: None}


def test_ignored_capture_is_dropped(spark, lines_of):
    rec = solr_log(lines_of({"f": "INFO skip this here"}), "%{LOGLEVEL:level_s} %{WORD:ignored} %{JAVALOGMESSAGE:logmessage}", date_format=None)
    assert "ignored" not in rec.columns and rec.first().message_txt_en == "this here"


def test_delivery_posts_once_and_in_parallel(spark, tmp_path):
    out = str(tmp_path / "sent")
    (tmp_path / "sent").mkdir()

    def post(endpoint, payload):
        import os
        import uuid
        open(os.path.join(out, uuid.uuid4().hex), "w").write(payload)
        return 200

    docs = to_documents(spark.range(0, 500, 1, 16).select(F.lit("f").alias("file"), F.col("id").alias("line_num"), F.col("id").cast("string").alias("v")))
    log = deliver(docs, ["e1", "e2"], post, batch_size=50, seed=3, max_parallel=2)
    import os
    posted = len(os.listdir(out))
    assert log.count() == posted and endpoint_stats(log).count() == 2
    assert len(os.listdir(out)) == posted and sum(r.n_docs for r in log.collect()) == 500


def test_manifest_lists_empty_files(spark, tmp_path):
    from logweave.operators.extract import raw_lines
    from logweave.plans.jobs import index_directory
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_text("x\n")
    (src / "empty.log").write_text("")
    (src / "b.txt").write_text("no\n")
    index_directory(spark, str(src), raw_lines, manifest=str(tmp_path / "m"), write_to=str(tmp_path / "out"))
    assert sorted(r.file.rsplit("/", 1)[1] for r in read_manifest(spark, str(tmp_path / "m")).collect()) == ["a.log", "empty.log"]
    assert list_files(spark, str(src), "*").count() == 3


def test_gzip_with_any_charset_or_delimiter(spark, tmp_path):
    (tmp_path / "a.log.gz").write_bytes(gzip.compress("eins\nzwei ä\n".encode("UTF-16")))
    (tmp_path / "b.log").write_bytes("drei\n".encode("UTF-16"))
    got = sorted((r.file[-2:], r.line_num, r.line) for r in read_log_lines(spark, str(tmp_path), match="*", charset="UTF-16").collect())
    assert got == [("gz", 1, "eins"), ("gz", 2, "zwei ä"), ("og", 1, "drei")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.log.gz").write_bytes(gzip.compress(b"p;q;;r"))
    assert [r.line for r in read_log_lines(spark, str(tmp_path / "c"), match="*", line_sep_regex=";+").orderBy("line_num").collect()] == ["p", "q", "r"]


def _tail(spark, src, state, **options):
    from logweave.streaming.tail import tail_once
    seen = []
    tail_once(spark, str(src), lambda df: seen.extend(sorted((r.file.rsplit("/", 1)[1], r.line_num, r.line) for r in df.collect())), str(state), **options)
    return seen


def test_tail_survives_rotation(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_text("one\ntwo\nthree\n")
    assert [x[2] for x in _tail(spark, src, tmp_path / "s")] == ["one", "two", "three"]
    (src / "a.log").write_text("x\ny\n")
    assert _tail(spark, src, tmp_path / "s") == [("a.log", 1, "x"), ("a.log", 2, "y")]
    with open(src / "a.log", "a") as f:
        f.write("z\nw\n")
    assert _tail(spark, src, tmp_path / "s") == [("a.log", 3, "z"), ("a.log", 4, "w")]
    assert _tail(spark, src, tmp_path / "s") == []


def test_tail_other_encodings_and_names(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_bytes("eins\nzw\xf6lf\ndrei\n".encode("latin-1"))
    (src / "b.txt").write_text("not this\n")
    (src / "empty.log").write_text("")
    assert [x[1] for x in _tail(spark, src, tmp_path / "s")] == [1, 2, 3]
    assert [x[2] for x in _tail(spark, src, tmp_path / "t", charset="ISO-8859-1")] == ["eins", "zw\xf6lf", "drei"]
    (src / "c.log").write_text("p;q;half")
    assert _tail(spark, src, tmp_path / "u", match="c.log", line_sep=";") == [("c.log", 1, "p"), ("c.log", 2, "q")]


def test_tail_repeats_a_failed_run(spark, tmp_path):
    from logweave.streaming.tail import tail_once
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_text("one\n")

    def fail(df):
        df.count()
        raise ValueError("sink")

    with pytest.raises(ValueError):
        tail_once(spark, str(src), fail, str(tmp_path / "s"))
    assert len(_tail(spark, src, tmp_path / "s")) == 1


def test_watch_charset(spark, tmp_path):
    from logweave.streaming.watch import watch_directory
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.log").write_bytes("zw\xf6lf\n".encode("latin-1"))
    q = watch_directory(spark, str(src), lambda lines, i: lines.write.mode("append").parquet(out), str(tmp_path / "c"), trigger={"availableNow": True}, charset="ISO-8859-1")
    q.awaitTermination(120)
    assert [r.line for r in spark.read.parquet(out).collect()] == ["zw\xf6lf"]


def test_blank_at_the_end_of_a_definition(spark):
    from logweave.functions.grok import PatternLibrary, default_library
    assert PatternLibrary().add_text("  A x \nB  y\n").definitions == {"A": "x ", "B": "y"}
    assert default_library().definitions["REDISLOG"].endswith(" ")
