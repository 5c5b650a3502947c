"""Registered queries over files, deliveries and typed documents.

The files are written by Spark from the given tables, below the shared checkpoint folder, and go when
the application ends."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.grok import compile_grok
from ..functions.plan import materialize
from ..operators.documents import explode_documents, preview_documents, to_documents
from ..operators.extract import json_lines, raw_lines
from ..operators.multiline import CONT, START, record_pieces
from ..operators.stats import endpoint_stats
from ..session import prepare, scratch_path
from ..sinks.batches import batch_documents, batch_documents_by_key
from ..sinks.deliver import deliver
from ..sources.files import _delete_at_end, list_files, list_sources, listed_paths, read_log_lines, read_manifest
from . import render as R
from .jobs import index_directory

#: Documents (or conversations) that one rendered file holds.
PER_FILE = 50


def _folder(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _delete_at_end(spark, path)
    return path


def _document_files(spark: SparkSession, d: str, base: str, codec: str | None = None) -> None:
    """One file for every ``PER_FILE`` documents, in order of their ids: one row, one file."""
    docs = R.table(spark, d, "documents").select(F.floor(F.col("doc_id") / PER_FILE).alias("part"), "doc_id", "text")
    files = docs.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("t"))  # PER_FILE each
    files = files.select("part", F.array_join(F.transform("t", lambda t: t["text"]), "\n").alias("value"))
    writer = files.write.partitionBy("part")
    (writer.option("compression", codec) if codec else writer).text(base)


def _part() -> Column:
    return F.regexp_extract("file", r"/part=(\d+)/", 1).cast("bigint")


_DOC_LINES = f"""
SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY doc_id, pos) AS BIGINT) AS line_num, line FROM (
  SELECT doc_id // {PER_FILE} AS part, doc_id, unnest(range(1, len(s) + 1)) AS pos, unnest(s) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))
"""


# --- S1, S5: exact line numbers and text of files cut into many splits --------------------------------
def read_files_numbered(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    base = _folder(spark, "numbered")
    _document_files(spark, d, base)
    return read_log_lines(spark, base, match=r".*\.txt").select(_part().alias("part"), "line_num", "line")


# --- S6, S7: manifest and offsets applied by the reader ----------------------------------------------
def read_with_state(spark: SparkSession, d: str) -> DataFrame:
    """Every third file is in the manifest; of the others, lines after the third are read."""
    prepare(spark)
    base = _folder(spark, "state")
    _document_files(spark, d, base)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(base)
    files = files.select(F.regexp_replace("path", "^file:(//)?(?=/)", "").alias("file"))
    lines = read_log_lines(spark, base, match=r".*\.txt", processed=files.filter(_part() % 3 == 0),
                           offsets=files.select("file", F.lit(3).cast("bigint").alias("last_line")))
    return lines.select(_part().alias("part"), "line_num", "line")


SQL_WITH_STATE = f"SELECT * FROM ({_DOC_LINES}) WHERE part % 3 <> 0 AND line_num > 3"


# --- S3, S4: gzip and a charset that is not ASCII-compatible -----------------------------------------
def read_charsets(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the documents as UTF-16 files, half of them gzip, read back and counted by source."""
    prepare(spark)
    base = _folder(spark, "charsets")
    docs = R.table(spark, d, "documents")
    lines = docs.select("source", "doc_id", F.explode(F.split("text", "\n")).alias("line"))
    for rest, codec in ((0, "none"), (1, "gzip")):
        (lines.filter(F.col("doc_id") % 2 == rest).select("source", "line").write.partitionBy("source")
         .option("encoding", "UTF-16").option("compression", codec).option("sep", "\x01").option("quote", "")
         .option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .csv(f"{base}/{codec}"))
    read = read_log_lines(spark, base, match=r".*\.csv(\.gz)?", charset="UTF-16")
    read = read.filter(F.trim("line") != "").withColumn("source", F.regexp_extract("file", r"/source=([^/]+)/", 1))
    return read.groupBy("source").agg(F.count("*").alias("lines"), F.sum(F.length("line")).cast("bigint").alias("chars"),
                                      F.sum(F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")).alias("sum"))


SQL_CHARSETS = """
SELECT source, COUNT(*) AS lines, SUM(length(line))::BIGINT AS chars, SUM(('0x' || left(md5(line), 8))::BIGINT)::BIGINT AS sum
FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line, ' ') <> '' GROUP BY source
"""


# --- P1: escapes in expressions ----------------------------------------------------------------------------
def grok_escapes(spark: SparkSession, d: str) -> DataFrame:
    """The first capitalised word of each document with a space after it, found through properties and
    code points instead of literal text."""
    prepare(spark)
    docs = R.table(spark, d, "documents").select("doc_id", F.col("text").alias("line"))
    grok = compile_grok(r"(?<word>\p{Lu}\p{Ll}+)\x20(?<next>\p{L}+)")
    return grok.apply(docs).where("_matched").select("doc_id", "word", "next")


SQL_ESCAPES = r"""
SELECT doc_id, regexp_extract(text, '(\p{Lu}\p{Ll}+) (\p{L}+)', 1) AS word, regexp_extract(text, '(\p{Lu}\p{Ll}+) (\p{L}+)', 2) AS next
FROM documents WHERE regexp_matches(text, '\p{Lu}\p{Ll}+ \p{L}+')
"""


# --- P2: mixed lines, each to the first expression that matches ---------------------------------------------
MIXED = {
    "access": "%{COMMONAPACHELOG}",
    "order": "%{SYSLOGBASE} order %{INT:order} status=%{WORD:status}",
    "turn": "^conv %{INT:conv} turn %{INT:turn} %{WORD:role}$",
    "number": "%{INT:number}",
}


def route_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Events as access lines, orders as system log lines and conversation turns, some of them broken, in one table."""
    from ..operators.routing import route_lines

    prepare(spark)
    events = R.table(spark, d, "events").select(F.concat(F.lit("10.0.0.1 - u [01/Jun/2017:00:00:00 +0000] \"GET /e/"), F.col("event_id"), F.lit(" HTTP/1.1\" 200 "), F.length("event_type")).alias("line"))
    orders = R.table(spark, d, "orders").select(F.concat(F.lit("Jun  1 00:00:00 host app[12]: order "), F.col("o_orderkey"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(" state=")).otherwise(F.lit(" status=")), "o_orderstatus").alias("line"))
    turns = R.table(spark, d, "conversations").select(F.concat(F.lit("conv "), F.when(F.col("turn") % 3 != 2, F.col("conv_id").cast("string")).otherwise(F.lit("none")),
                                                               F.lit(" turn "), F.when(F.col("turn") % 3 != 2, F.col("turn").cast("string")).otherwise(F.lit("none")), F.lit(" "), F.col("role")).alias("line"))
    routed = route_lines(events.unionByName(orders).unionByName(turns), MIXED)
    f = lambda name: F.col("fields")[name]
    key = (F.when(F.col("expression") == "access", F.concat_ws("|", f("request"), f("bytes"))).when(F.col("expression") == "order", F.concat_ws("|", f("order"), f("status"), f("pid")))
           .when(F.col("expression") == "turn", F.concat_ws("|", f("conv"), f("turn"), f("role"))).when(F.col("expression") == "number", f("number")))
    return routed.groupBy("expression", key.alias("key")).agg(F.count("*").alias("n"))


SQL_MIXED = """
WITH k AS (
  SELECT 'access' AS expression, '/e/' || event_id || '|' || length(event_type) AS key FROM events
  UNION ALL SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'number' ELSE 'order' END, CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE o_orderkey || '|' || o_orderstatus || '|12' END FROM orders
  UNION ALL SELECT CASE WHEN turn % 3 <> 2 THEN 'turn' END, CASE WHEN turn % 3 <> 2 THEN conv_id || '|' || turn || '|' || role END FROM conversations)
SELECT expression, key, COUNT(*) AS n FROM k GROUP BY ALL
"""


# --- T2: a tail over files that grow ----------------------------------------------------------------------
def tail_growth(spark: SparkSession, d: str) -> DataFrame:
    """Conversation logs that appear in two steps, each followed by a tail run: every line once."""
    from ..streaming.tail import tail_once

    prepare(spark)
    base = _folder(spark, "tail")
    turns = R.table(spark, d, "conversations").select(
        F.floor(F.col("conv_id") / PER_FILE).alias("part"), "conv_id", "turn",
        F.concat("role", F.lit(": "), F.regexp_replace("text", "\n", " ")).alias("line"))
    files = turns.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "line"))), lambda t: t["line"]).alias("t"))
    files = files.checkpoint()
    out = f"{base}/out"
    for step, upto in ((1, F.floor(F.size("t") / 2)), (2, F.size("t"))):
        grown = files.select("part", F.array_join(F.slice("t", F.lit(1), upto.cast("int")), "\n").alias("value"))
        grown.filter("value <> ''").write.partitionBy("part").text(f"{base}/step{step}")
        _put_in_place(spark, f"{base}/step{step}", f"{base}/in")
        tail_once(spark, f"{base}/in", lambda lines: lines.write.mode("append").parquet(out), f"{base}/offsets", match="*.log")
    got = spark.read.parquet(out)
    return got.select(F.regexp_extract("file", r"/(\d+)\.log$", 1).cast("bigint").alias("part"), "line_num", "line")


def _put_in_place(spark: SparkSession, src: str, dst: str) -> None:
    """Give the written files stable names, replacing their shorter predecessors: ``<part>.log``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(dst))
    there = {at.rsplit("/", 1)[1] for at in listed_paths(spark, dst, "*.log")}
    for written in listed_paths(spark, src, "*=*/part-*"):  # two calls of the JVM for a file count where files are many
        name = f"{written.split('/')[-2].split('=')[1]}.log"
        target = path(f"{dst}/{name}")
        if name in there:
            fs.delete(target, False)
        fs.rename(path(written), target)


SQL_TAIL_GROWTH = f"""
SELECT conv_id // {PER_FILE} AS part, CAST(row_number() OVER (PARTITION BY conv_id // {PER_FILE} ORDER BY conv_id, turn) AS BIGINT) AS line_num,
  role || ': ' || replace(text, chr(10), ' ') AS line
FROM conversations
"""


# --- P9: a file that is one record -----------------------------------------------------------------------
PIECE_LINES = 500


def one_record_file(spark: SparkSession, d: str) -> DataFrame:
    """All lines of the documents as one file without a record start: its text in pieces."""
    prepare(spark)
    docs = R.table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("t"))
    # line numbers by sums over runs of documents, then over the runs
    run = docs.select("doc_id", F.floor(F.col("doc_id") / PER_FILE).alias("run"), F.size("t").alias("n"))
    inside = Window.partitionBy("run").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    run = run.withColumn("in_run", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    runs = run.groupBy(F.col("run").alias("r")).agg(F.sum("n").alias("all"))
    runs = runs.select("r", F.coalesce(F.sum("all").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    start = run.join(runs, F.col("run") == F.col("r")).select(F.col("doc_id").alias("id"), (F.col("base") + F.col("in_run")).alias("before"))
    lines = docs.join(start, F.col("doc_id") == F.col("id")).select("before", F.posexplode("t").alias("pos", "line"))
    lines = lines.select(F.lit("one.log").alias("file"), (F.col("before") + F.col("pos") + 1).alias("line_num"),
                         F.lit(CONT).alias("state"), F.concat("line", F.lit("\n")).alias("piece"))
    pieces = record_pieces(lines, "piece", chunk_lines=PIECE_LINES)
    return pieces.select("first_line", "part_no", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("md5"))


SQL_ONE_RECORD = f"""
WITH l AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
n AS (SELECT row_number() OVER (ORDER BY doc_id, pos) AS line_num, line FROM l),
p AS (SELECT (line_num - 1) // {PIECE_LINES} AS part_no, string_agg(line || chr(10), '' ORDER BY line_num) AS t FROM n GROUP BY 1)
SELECT CAST(1 AS BIGINT) AS first_line, CAST(part_no AS BIGINT) AS part_no, length(t) AS chars, md5(t) AS md5 FROM p
"""


# --- K1, K2, A3: batches per partition, delivery, totals ---------------------------------------------
def _order_documents(spark: SparkSession, d: str) -> DataFrame:
    orders = R.table(spark, d, "orders")
    return to_documents(orders.select(F.lit("orders.log").alias("file"), F.col("o_orderkey").alias("line_num"),
                                      F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_totalprice"))


def partition_batches(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    b = batch_documents(_order_documents(spark, d), n=100)
    return b.agg(F.sum("n_docs").cast("bigint").alias("docs"), F.max("n_docs").alias("largest"))


SQL_PARTITION_BATCHES = "SELECT COUNT(*) AS docs, CAST(100 AS INTEGER) AS largest FROM orders"


def endpoint_totals(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries to two endpoints of which one always refuses: what the other one got."""
    prepare(spark)

    def post(endpoint, payload):  # the client of this query: no network
        return 503 if endpoint == "down" else 200

    log = deliver(_order_documents(spark, d), ["down", "up"], post, batch_size=100, retry_wait_s=0.0, seed=1,
                  log_path=_folder(spark, "delivery"))
    return endpoint_stats(log).select("endpoint", F.col("docs_sent").cast("bigint").alias("docs_sent"))


SQL_ENDPOINTS = "SELECT 'up' AS endpoint, COUNT(*) AS docs_sent FROM orders"


def deliver_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries to a client that refuses a third of the batches until the run is started again: documents sent, and
    batches that were sent twice."""
    from ..sinks.outbox import deliver_once
    from ..sinks.tombstones import _store

    prepare(spark)
    base = _folder(spark, "outbox")

    def post(endpoint, payload):  # the client of this query: it writes down what it takes
        import hashlib
        import uuid as ids

        fs, folder = _store(base)
        name = hashlib.md5(payload.encode()).hexdigest()
        if int(name, 16) % 3 == 0 and fs.get_file_info(f"{folder}/up").type.name == "NotFound":
            return 503
        fs.create_dir(f"{folder}/posts", recursive=True)
        with fs.open_output_stream(f"{folder}/posts/{name}-{ids.uuid4().hex}") as f:
            f.write(str(payload.count('"fields"')).encode())
        return 200

    for again in (False, True):
        if again:
            fs, folder = _store(base)
            fs.open_output_stream(f"{folder}/up").close()
        try:
            deliver_once(_order_documents(spark, d), ["one"], post, f"{base}/run", batch_size=100, retry_wait_s=0.0, seed=1)
        except Exception as e:
            if again or "could not be delivered" not in str(e):
                raise
    posts = spark.read.text(f"{base}/posts").select(F.col("value").cast("bigint").alias("docs"), F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(1)).alias("batch"))
    return posts.groupBy("batch").agg(F.sum("docs").alias("docs"), F.count("*").alias("times")).agg(
        F.sum("docs").alias("docs"), F.sum((F.col("times") > 1).cast("bigint")).alias("sent_twice"))


SQL_RESUMED = "SELECT CAST(COUNT(*) AS BIGINT) AS docs, CAST(0 AS BIGINT) AS sent_twice FROM orders"


def batch_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Batches of ten customers of each market segment: the documents' ids and the payload's md5."""
    prepare(spark)
    customers = R.table(spark, d, "customer").select(F.lit("customer.log").alias("file"), F.col("c_custkey").alias("line_num"), F.col("c_custkey").cast("string").alias("id"),
                                                     "c_name", "c_nationkey", "c_mktsegment", "c_custkey")
    docs = to_documents(customers, fields=["id", "c_name", "c_nationkey"], keep=["c_mktsegment", "c_custkey"])
    return batch_documents_by_key(docs, "c_mktsegment", "c_custkey", n=10).select("c_mktsegment", "batch_no", "n_docs", "min_id", "max_id", F.md5("payload").alias("md5"))


SQL_PAYLOADS = """
WITH c AS (SELECT *, CAST(c_custkey AS VARCHAR) AS id, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 10 AS batch_no FROM customer),
j AS (SELECT *, '{"id":"' || id || '","fields":[{"name":"_src_","value":"customer.log:' || id || '"},{"name":"c_name","value":"' || c_name
  || '"},{"name":"c_nationkey","value":"' || c_nationkey || '"},{"name":"id","value":"' || id || '"}]}' AS doc FROM c)
SELECT c_mktsegment, CAST(batch_no AS BIGINT) AS batch_no, CAST(COUNT(*) AS INTEGER) AS n_docs, MIN(id) AS min_id, MAX(id) AS max_id,
  md5('[' || string_agg(doc, ',' ORDER BY c_custkey) || ']') AS md5 FROM j GROUP BY c_mktsegment, batch_no
"""


# --- A4: progress of a directory job ----------------------------------------------------------------------
def progress_report(spark: SparkSession, d: str) -> DataFrame:
    """The documents' files indexed in groups: the last row of the progress table."""
    from ..streaming.progress import ProgressLog, read_progress

    prepare(spark)
    base = _folder(spark, "progress")
    _document_files(spark, d, f"{base}/in")
    n = list_sources(spark, f"{base}/in", r".*\.txt").count()
    log = ProgressLog(f"{base}/progress", every_files=max(1, n // 4))
    index_directory(spark, f"{base}/in", raw_lines, match=r".*\.txt", manifest=f"{base}/done", write_to=f"{base}/out", files_per_pass=-(-n // 4), progress=log)
    last = read_progress(spark, f"{base}/progress").filter("final")
    return last.select("files", "lines_read", "lines_parsed", "lines_skipped", "docs")


SQL_PROGRESS = f"""
SELECT COUNT(DISTINCT part) AS files, COUNT(*) AS lines_read, COUNT(*) AS lines_parsed, CAST(0 AS BIGINT) AS lines_skipped,
  COUNT(*) FILTER (regexp_matches(line, '[^\\x00-\\x20]')) AS docs FROM ({_DOC_LINES})
"""


# --- D1: typed values; D3: preview ---------------------------------------------------------------------------
def _event_documents(spark: SparkSession, d: str, typed: bool) -> DataFrame:
    lines = R.table(spark, d, "events").select(
        F.lit("events.json").alias("file"), F.col("event_id").alias("line_num"),
        F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), "user_id", F.parse_json("props").alias("props"),
                           (F.col("value") > 10).alias("high"), "event_type")).alias("line"))
    rec = json_lines(lines).where("_matched")
    return to_documents(rec.select("file", "line_num", "fields"), typed=typed)


def json_documents(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, booleans and nested objects of JSON lines keep their types in documents."""
    prepare(spark)
    rows = explode_documents(_event_documents(spark, d, True))
    kind = F.when(F.schema_of_variant("value").startswith("OBJECT"), "OBJECT").otherwise(F.schema_of_variant("value"))
    return rows.filter("name <> '_src_'").select(F.col("id").cast("bigint").alias("id"), "name", kind.alias("kind"), F.to_json("value").alias("json"))


SQL_JSON_DOCUMENTS = """
WITH e AS (SELECT event_id AS id, user_id, props, value > 10 AS high, event_type FROM events)
SELECT id, 'id' AS name, 'STRING' AS kind, '"' || id || '"' AS json FROM e
UNION ALL SELECT id, 'user_id', 'BIGINT', CAST(user_id AS VARCHAR) FROM e WHERE user_id IS NOT NULL
UNION ALL SELECT id, 'props', 'OBJECT', CAST(CAST(props AS JSON) AS VARCHAR) FROM (SELECT id, replace(props, ' ', '') AS props FROM e) WHERE props IS NOT NULL
UNION ALL SELECT id, 'high', 'BOOLEAN', CAST(high AS VARCHAR) FROM e WHERE high IS NOT NULL
UNION ALL SELECT id, 'event_type', 'STRING', '"' || event_type || '"' FROM e WHERE event_type IS NOT NULL
"""


def preview(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    shown = preview_documents(_event_documents(spark, d, False))
    parsed = materialize(shown, "__p", F.from_json("json", "struct<id:string,fields:array<struct<name:string,value:string>>>"))
    return parsed.select(F.col("__p.id").cast("bigint").alias("id"), F.size("__p.fields").cast("bigint").alias("n_fields"),
                         (F.col("json").contains("\n")).alias("pretty"))


SQL_PREVIEW = """
SELECT event_id AS id, CAST(2 + (user_id IS NOT NULL)::INT + (props IS NOT NULL)::INT + (value IS NOT NULL)::INT + (event_type IS NOT NULL)::INT AS BIGINT) AS n_fields,
  true AS pretty FROM events
"""


# --- the one-shot directory job: parse with a custom function, write, manifest ---------------------------
def index_files(spark: SparkSession, d: str) -> DataFrame:
    """Two passes over the document files; the second finds all of them in the manifest."""
    prepare(spark)
    base = _folder(spark, "index")
    _document_files(spark, d, f"{base}/in")
    for _ in range(2):
        counts = index_directory(spark, f"{base}/in", raw_lines, match=r".*\.txt", manifest=f"{base}/done", write_to=f"{base}/out")
    done = read_manifest(spark, f"{base}/done").groupBy("file").agg(F.count("*").alias("times"))
    return counts.join(done, "file").select(_part().alias("part"), "docs", "times")


SQL_INDEX = f"""
SELECT part, COUNT(*) AS docs, CAST(1 AS BIGINT) AS times FROM ({_DOC_LINES})
WHERE regexp_matches(line, '[^\\x00-\\x20]') GROUP BY part
"""

# --- S5, S7: the persisted line index --------------------------------------------------------------------
def read_indexed(spark: SparkSession, d: str) -> DataFrame:
    """The documents' files, grown once between two reads with one line index; the second read begins after
    the third line of every file."""
    prepare(spark)
    base = _folder(spark, "indexed")
    docs = R.table(spark, d, "documents").select(F.floor(F.col("doc_id") / PER_FILE).alias("part"), "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    _versions(spark, docs, base, (0.5, 1.0),
              lambda folder: read_log_lines(spark, folder, index_dir=f"{base}/index").write.format("noop").mode("overwrite").save())
    files = list_sources(spark, f"{base}/in").select("file", F.lit(3).cast("bigint").alias("last_line"))
    lines = read_log_lines(spark, f"{base}/in", index_dir=f"{base}/index", offsets=files)
    return lines.select(F.regexp_extract("file", r"/(\d+)\.log$", 1).cast("bigint").alias("part"), "line_num", "line")


SQL_INDEXED = f"SELECT * FROM ({_DOC_LINES}) WHERE line_num > 3"


def _versions(spark: SparkSession, lines: DataFrame, base: str, shares, after, mark: bool = False) -> None:
    """Write ``lines`` (part, ..., line) as one file for each part, once for each share of its lines, each time in the
    place of the file before; ``after`` runs on the folder each time.  ``mark``: the version's number before each line."""
    order = [F.col(c) for c in lines.columns if c not in ("part", "line")]
    files = lines.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, "line"))), lambda t: t["line"]).alias("t")).checkpoint()
    for step, share in enumerate(shares, 1):
        value = F.slice("t", F.lit(1), F.ceil(F.size("t") * share).cast("int"))
        if mark:
            value = F.transform(value, lambda x: F.concat(F.lit(f"{step} "), x))  # noqa: B023
        files.select("part", F.array_join(value, "\n").alias("value")).write.partitionBy("part").text(f"{base}/step{step}")
        _put_in_place(spark, f"{base}/step{step}", f"{base}/in")
        after(f"{base}/in")


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return R.table(spark, d, "conversations").select(
        F.floor(F.col("conv_id") / PER_FILE).alias("part"), "conv_id", "turn",
        F.concat("role", F.lit(": "), F.regexp_replace("text", "\n", " ")).alias("line"))


# --- T2: files that are replaced by longer ones and by ones of the same size ------------------------------
def tail_rotation(spark: SparkSession, d: str) -> DataFrame:
    """Conversation logs in three versions, each in the place of the one before: half of the lines, all lines (longer)
    and other lines of the same length.  Each version's lines are delivered once."""
    from ..streaming.tail import tail_once

    prepare(spark)
    base = _folder(spark, "rotation")
    out = f"{base}/out"
    _versions(spark, _turns(spark, d), base, (0.5, 1.0, 1.0), mark=True, after=lambda folder: tail_once(
        spark, folder, lambda lines: lines.write.mode("append").parquet(out), f"{base}/offsets", match="*.log"))
    got = spark.read.parquet(out)
    return got.select(F.regexp_extract("file", r"/(\d+)\.log$", 1).cast("bigint").alias("part"), "line_num", "line")


SQL_TAIL_ROTATION = f"""
WITH t AS (SELECT *, COUNT(*) OVER (PARTITION BY part) AS n FROM ({SQL_TAIL_GROWTH}) x)
SELECT part, line_num, '1 ' || line AS line FROM t WHERE line_num <= ceil(n * 0.5)
UNION ALL SELECT part, line_num, '2 ' || line FROM t UNION ALL SELECT part, line_num, '3 ' || line FROM t
"""


# --- K5, T1: a watched folder whose files go when they are done --------------------------------------------
def watch_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents' files, of which those of even parts match the name rule, watched with removal: the lines read of
    each file and whether it is still there."""
    from ..streaming.watch import clean_watched, watch_directory

    prepare(spark)
    base = _folder(spark, "clean")
    _document_files(spark, d, f"{base}/written")
    _put_in_place(spark, f"{base}/written", f"{base}/in")
    out = f"{base}/out"
    for _ in range(2):  # the second run has nothing left to read
        watch_directory(spark, f"{base}/in", lambda lines, i: lines.write.mode("append").parquet(out), f"{base}/checkpoint", match=r"\d*[02468]\.log",
                        trigger={"availableNow": True}, max_files_per_trigger=7, clean_source="delete").awaitTermination()
    clean_watched(spark, f"{base}/checkpoint")
    part = F.regexp_extract("file", r"/(\d+)\.log$", 1).cast("bigint")
    read = spark.read.parquet(out).groupBy(part.alias("part")).agg(F.count("*").alias("lines"))
    left = list_files(spark, f"{base}/in", "*.log").select(part.alias("part"), F.lit(True).alias("left")).checkpoint()
    return read.join(left, "part", "full").select("part", F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"), F.coalesce("left", F.lit(False)).alias("still_there"))


SQL_WATCH_CLEAN = f"""
SELECT part, CASE WHEN part % 2 = 0 THEN COUNT(*) ELSE 0 END AS lines, part % 2 = 1 AS still_there FROM ({_DOC_LINES}) GROUP BY part
"""


# --- T3: records of a stream, the open one in state --------------------------------------------------------
def stream_turns(spark: SparkSession, d: str) -> DataFrame:
    """Lines of conversation logs in three arrivals, with a restart of the stream after each; a user's turn begins a
    record.  Every record once; the last of each file comes by the timer."""
    from ..streaming.records import state_store, stop_when_taken, stream_records

    prepare(spark)
    base = _folder(spark, "records")
    turns = _turns(spark, d)
    lines = turns.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "line"))).alias("t"))  # PER_FILE conversations
    lines = lines.select("part", F.size("t").alias("n"), F.posexplode("t").alias("i", "t"))
    lines = lines.select(F.col("part").cast("string").alias("file"), (F.col("i") + 1).cast("bigint").alias("line_num"),
                         F.when(F.col("t.line").startswith("user: "), START).otherwise(CONT).alias("state"), F.concat("t.line", F.lit("\n")).alias("text"),
                         (F.lit(2) - F.floor((F.col("n") - 1 - F.col("i")) * 3 / F.col("n"))).alias("arrival")).checkpoint()
    schema = "file string, line_num bigint, state string, text string"
    for arrival in range(3):
        lines.filter(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(schema).parquet(f"{base}/in")
        last = arrival == 2
        with state_store(spark, 4):
            query = (stream_records(source, idle_seconds=0.5 if last else 3600.0).writeStream.format("parquet")
                     .option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="200 milliseconds").start(f"{base}/out"))
        stop_when_taken(query, flushed=last)
    return spark.read.parquet(f"{base}/out").select(
        F.col("file").cast("bigint").alias("part"), "first_line", "last_line", "n_lines", F.md5("text").alias("md5"), "idle")


SQL_STREAM_TURNS = f"""
WITH l AS (SELECT *, SUM(CASE WHEN starts_with(line, 'user: ') THEN 1 ELSE 0 END) OVER (PARTITION BY part ORDER BY line_num) AS rec FROM ({SQL_TAIL_GROWTH}) x),
r AS (SELECT part, rec, MIN(line_num) AS first_line, MAX(line_num) AS last_line, COUNT(*) AS n_lines, md5(string_agg(line || chr(10), '' ORDER BY line_num)) AS md5 FROM l GROUP BY part, rec)
SELECT part, first_line, last_line, n_lines, md5, rec = MAX(rec) OVER (PARTITION BY part) AS idle FROM r
"""

FILE_QUERIES = {
    "read_files_numbered": (read_files_numbered, _DOC_LINES),
    "read_with_state": (read_with_state, SQL_WITH_STATE),
    "read_charsets": (read_charsets, SQL_CHARSETS),
    "grok_escapes": (grok_escapes, SQL_ESCAPES),
    "one_record_file": (one_record_file, SQL_ONE_RECORD),
    "tail_growth": (tail_growth, SQL_TAIL_GROWTH),
    "partition_batches": (partition_batches, SQL_PARTITION_BATCHES),
    "endpoint_totals": (endpoint_totals, SQL_ENDPOINTS),
    "json_documents": (json_documents, SQL_JSON_DOCUMENTS),
    "preview": (preview, SQL_PREVIEW),
    "index_files": (index_files, SQL_INDEX),
    "read_indexed": (read_indexed, SQL_INDEXED),
    "tail_rotation": (tail_rotation, SQL_TAIL_ROTATION),
    "route_mixed": (route_mixed, SQL_MIXED),
    "deliver_resumed": (deliver_resumed, SQL_RESUMED),
    "batch_payloads": (batch_payloads, SQL_PAYLOADS),
    "progress_report": (progress_report, SQL_PROGRESS),
    "watch_clean": (watch_clean, SQL_WATCH_CLEAN),
    "stream_turns": (stream_turns, SQL_STREAM_TURNS),
}
