"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query renders a whole table as log text (Spark-side), runs one of the library's jobs on it
and returns scalar columns.  The oracle computes the same columns straight from the source
table, so it shares no regex with the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import explode_documents, to_documents
from ..operators.extract import dns_log, grok_extract, json_lines, normalize_timestamp, raw_lines
from ..operators.multiline import xml_field_docs
from ..operators.normalize import ignore_before, normalize_lines, route_unmatched
from ..operators.solr import solr_log
from ..operators.stats import file_stats, multiline_stats, run_stats, status_of
from ..session import prepare, scratch_path
from ..sinks.batches import batch_documents_by_key
from ..sources.files import after_offsets, read_log_lines, skip_processed
from .catalog_files import FILE_QUERIES
from . import render as R

HTTPD_DATE = "dd/MMM/yyyy:HH:mm:ss Z"
SEARCH_LOG = "%{SOLR_651_LOG4J}"

# --- shared SQL fragments ------------------------------------------------------------------------
_EV_FILE = "'events/part-' || CAST(event_id // 10000 AS VARCHAR) || '.log'"
_EV_LINE = "CAST(event_id % 10000 + 1 AS BIGINT)"
_EV_IP = ("'10.' || CAST((event_id // 65536) % 256 AS VARCHAR) || '.' || CAST((event_id // 256) % 256 AS VARCHAR)"
          " || '.' || CAST(event_id % 256 AS VARCHAR)")
_TRIM = "regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
_COLLAPSE = "regexp_replace({0}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
_ISO_S = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || '.000Z'"


def _events(spark, d):
    return R.table(spark, d, "events")


# --- P1/P5: access log ----------------------------------------------------------------------------
def apache_extract(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = grok_extract(normalize_lines(R.access_lines(_events(spark, d))), "%{COMMONAPACHELOG}")
    rec = normalize_timestamp(route_unmatched(rec), "timestamp", HTTPD_DATE, "ts")
    return rec.select("file", "line_num", "clientip", "ident", "auth", "timestamp", "verb", "request",
                      "httpversion", "rawrequest", "response", "bytes", "ts")


SQL_APACHE = f"""
SELECT {_EV_FILE} AS file, {_EV_LINE} AS line_num, {_EV_IP} AS clientip, '-' AS ident,
  'user' || CAST(user_id AS VARCHAR) AS auth, strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS timestamp,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN 'POST'
       WHEN event_type = 'signup' THEN 'PUT' ELSE 'GET' END AS verb,
  CASE WHEN event_type = 'error' THEN NULL
       ELSE '/' || event_type || '/' || CAST(event_id AS VARCHAR) || '?user=' || CAST(user_id AS VARCHAR) END AS request,
  CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE '1.1' END AS httpversion,
  CASE WHEN event_type = 'error' THEN 'BAD-REQUEST' END AS rawrequest,
  CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS response,
  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(event_id * 7 + user_id AS VARCHAR) END AS bytes,
  {_ISO_S.format('ts')} AS ts
FROM events
"""


# --- P3: typed captures (ELB) -------------------------------------------------------------------------
def typed_captures(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = grok_extract(normalize_lines(R.elb_lines_of(R.table(spark, d, "lineitem"))), "%{ELB_ACCESS_LOG}")
    return route_unmatched(rec).select(
        "file", "line_num", "timestamp", "elb", "clientip", "clientport", "backendip", "backendport",
        "request_processing_time", "backend_processing_time", "response_processing_time", "response",
        "backend_response", "received_bytes", "bytes", "verb", "proto", "urihost", "port", "path", "params",
        "httpversion", "request")


SQL_TYPED = """
SELECT 'elb/part-' || CAST(l_orderkey // 1000 AS VARCHAR) || '.log' AS file,
  CAST((l_orderkey % 1000) * 8 + l_linenumber AS BIGINT) AS line_num,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, 'elb-' || CAST(l_suppkey AS VARCHAR) AS elb,
  '10.0.' || CAST((l_partkey // 256) % 256 AS VARCHAR) || '.' || CAST(l_partkey % 256 AS VARCHAR) AS clientip,
  CAST(1000 + l_linenumber AS BIGINT) AS clientport,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE '192.168.1.' || CAST(l_linenumber AS VARCHAR) END AS backendip,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(8000 + l_linenumber AS BIGINT) END AS backendport,
  l_discount AS request_processing_time, l_tax AS backend_processing_time, l_quantity AS response_processing_time,
  CAST(200 AS BIGINT) AS response, CAST(200 + l_linenumber AS BIGINT) AS backend_response,
  CAST(l_orderkey AS BIGINT) AS received_bytes, CAST(l_partkey AS BIGINT) AS bytes,
  'GET' AS verb, 'http' AS proto, 'shop.example.com:80' AS urihost, '80' AS port,
  '/orders/' || CAST(l_orderkey AS VARCHAR) AS path, '?line=' || CAST(l_linenumber AS VARCHAR) AS params,
  '1.1' AS httpversion,
  'http://shop.example.com:80/orders/' || CAST(l_orderkey AS VARCHAR) || '?line=' || CAST(l_linenumber AS VARCHAR) AS request
FROM lineitem
"""


# --- N6: unmatched routing --------------------------------------------------------------------------
def unmatched_routing(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = grok_extract(normalize_lines(R.access_lines(_events(spark, d), broken_errors=True)))
    rec = route_unmatched(rec, "unmatched_line")
    return rec.select("file", "line_num", F.col("_matched").alias("matched"), "clientip", "response", "unmatched_line")


SQL_UNMATCHED = f"""
SELECT {_EV_FILE} AS file, {_EV_LINE} AS line_num, event_type <> 'error' AS matched,
  CASE WHEN event_type <> 'error' THEN {_EV_IP} END AS clientip,
  CASE WHEN event_type <> 'error' THEN '200' END AS response,
  CASE WHEN event_type = 'error'
       THEN 'ERROR event ' || CAST(event_id AS VARCHAR) || ' for user ' || CAST(user_id AS VARCHAR) END AS unmatched_line
FROM events
"""


# --- N5: ignore-before ----------------------------------------------------------------------------------
def ignore_before_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = route_unmatched(grok_extract(normalize_lines(R.access_lines(_events(spark, d)))))
    rec = normalize_timestamp(rec, "timestamp", HTTPD_DATE, "ts_iso", ts_col="ts")
    return ignore_before(rec, "2024-01-15T00:00:00", "ts").select("file", "line_num", "ts_iso")


SQL_IGNORE_BEFORE = f"""
SELECT {_EV_FILE} AS file, {_EV_LINE} AS line_num, {_ISO_S.format('ts')} AS ts_iso
FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-15 00:00:00'
"""


# --- P7: JSON lines -------------------------------------------------------------------------------------
def json_lines_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = json_lines(normalize_lines(R.json_lines_of(_events(spark, d)))).where("_matched")
    f = F.col("fields")
    return rec.select(
        "file", "line_num",
        F.variant_get(f["event_id"], "$", "bigint").alias("event_id"),
        F.variant_get(f["type"], "$", "string").alias("event_type"),
        F.variant_get(f["user"], "$.id", "bigint").alias("user_id"),
        F.variant_get(f["value"], "$", "double").alias("value"),
        F.variant_get(f["props"], "$.k", "bigint").alias("k"),
        F.size(f).alias("n_fields"))


SQL_JSON = f"""
SELECT {_EV_FILE} AS file, {_EV_LINE} AS line_num, CAST(event_id AS BIGINT) AS event_id, event_type,
  CAST(user_id AS BIGINT) AS user_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CAST(5 AS INTEGER) AS n_fields
FROM events WHERE event_type <> 'signup'
"""


# --- P8: raw lines; S6: skip processed ----------------------------------------------------------------
def raw_lines_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = raw_lines(normalize_lines(R.text_lines_of(R.table(spark, d, "documents"))))
    return rec.select("file", "line_num", "id", "_raw_content_")


_DOC_LINES = f"""
WITH l AS (
  SELECT doc_id, 'docs/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS file,
         unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n
  FROM documents {{where}}),
t AS (SELECT file, CAST(n AS BIGINT) AS line_num, {_TRIM.format('line')} AS line FROM l)
SELECT file, line_num, file || ':' || CAST(line_num AS VARCHAR) AS id, line AS _raw_content_ FROM t WHERE line <> ''
"""
SQL_RAW = _DOC_LINES.format(where="")


def skip_processed_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    docs = R.table(spark, d, "documents")
    manifest = R.table(spark, d, "labels").join(docs.select("doc_id", "source"), "doc_id").select(
        R.doc_file().alias("file"))
    lines = skip_processed(R.text_lines_of(docs), manifest)
    return raw_lines(normalize_lines(lines)).select("file", "line_num", "id", "_raw_content_")


SQL_SKIP = _DOC_LINES.format(where="WHERE doc_id NOT IN (SELECT doc_id FROM labels)")


# --- P6: DNS -----------------------------------------------------------------------------------------------
def dns_extract(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = dns_log(normalize_lines(R.dns_lines_of(_events(spark, d)))).where("_matched")
    return rec.select("file", "line_num", "logdate", "host", "client", "query", "type", "timestamp")


SQL_DNS = f"""
SELECT {_EV_FILE} AS file, {_EV_LINE} AS line_num, strftime(ts, '%b %d %H:%M:%S') AS logdate,
  'dns' || CAST(user_id % 8 AS VARCHAR) || '.corp' AS host,
  '10.1.' || CAST((event_id // 256) % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS client,
  event_type || CAST(event_id AS VARCHAR) || '.example.com' AS query,
  CASE WHEN event_type = 'purchase' THEN 'AAAA' ELSE 'A' END AS type,
  {_ISO_S.format('ts')} AS timestamp
FROM events
"""


# --- P9/P11/P12: multi-line search log --------------------------------------------------------------
def multiline_log(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = solr_log(normalize_lines(R.solr_doc_lines(R.table(spark, d, "documents"))), SEARCH_LOG)
    return rec.select("file", "line_i", "n_lines", "level_s", "timestamp_tdt", "category_s", "mdc_s",
                      "collection_s", "shard_s", "replica_s", "core_s", "message_txt_en")


SQL_MULTILINE = f"""
WITH d AS (
  SELECT doc_id, source, lang, 'solr/' || source || '/part-' || CAST(doc_id // 64 AS VARCHAR) || '.log' AS file,
         string_split(text, chr(10)) AS parts FROM documents),
o AS (SELECT *, COALESCE(SUM(len(parts) + 1) OVER (PARTITION BY file ORDER BY doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM d),
l AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM d),
c AS (SELECT doc_id, i, {_COLLAPSE.format(_TRIM.format('line'))} AS cl FROM l),
m AS (SELECT doc_id, COUNT(*) AS n, string_agg(' ' || cl, '' ORDER BY i) AS cont FROM c WHERE cl <> '' GROUP BY doc_id)
SELECT o.file, CAST(o.off + 1 AS BIGINT) AS line_i, CAST(1 + COALESCE(m.n, 0) AS BIGINT) AS n_lines,
  'INFO' AS level_s,
  strftime(TIMESTAMP '2017-06-01 00:00:00' + to_seconds(o.doc_id), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS timestamp_tdt,
  'org.apache.solr.update.processor.LogUpdateProcessorFactory' AS category_s,
  'c:' || o.source || ' s:shard' || CAST(o.doc_id % 4 + 1 AS VARCHAR) || ' r:core_node' || CAST(o.doc_id % 3 + 1 AS VARCHAR)
    || ' x:' || o.source || '_shard' || CAST(o.doc_id % 4 + 1 AS VARCHAR) || '_replica1' AS mdc_s,
  o.source AS collection_s, 'shard' || CAST(o.doc_id % 4 + 1 AS VARCHAR) AS shard_s,
  'core_node' || CAST(o.doc_id % 3 + 1 AS VARCHAR) AS replica_s,
  o.source || '_shard' || CAST(o.doc_id % 4 + 1 AS VARCHAR) || '_replica1' AS core_s,
  'doc ' || CAST(o.doc_id AS VARCHAR) || ' lang=' || o.lang || COALESCE(m.cont, '') AS message_txt_en
FROM o LEFT JOIN m ON o.doc_id = m.doc_id
"""


# --- P13/P14: request fields and parameters ----------------------------------------------------------
def solr_requests(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = solr_log(normalize_lines(R.request_lines_of(R.ordered_table(spark, d, "orders", "o_orderkey"))), SEARCH_LOG)
    p = F.col("params")
    return rec.select(
        "file", "line_i", "level_s", "timestamp_tdt", "category_s", "collection_s", "shard_s", "replica_s", "core_s",
        "core_node_name_s", "webapp_s", "path_s", "params_s", "hits_i", "status_i", "qtime_i",
        p["q_s"].alias("q_s"), p["fq_s"].alias("fq_s"), p["prio_s"].alias("prio_s"), p["rows_s"].alias("rows_s"),
        F.when(p.isNotNull(), F.size(p)).alias("n_params"), "message_txt_en")


_REQ_SHARD = "CAST(o_custkey % 4 + 1 AS VARCHAR)"
_REQ_PARAMS = ("'q=cust:' || CAST(o_custkey AS VARCHAR) || '&fq=status:' || o_orderstatus || '&prio=' || "
               "o_orderpriority || '&_=1496325493119&rows=10&flag&q=order:' || CAST(o_orderkey AS VARCHAR)")
SQL_REQUESTS = f"""
WITH r AS (SELECT *, o_orderstatus <> 'P' AS req FROM orders)
SELECT 'requests/part-' || CAST(o_orderkey // 1000 AS VARCHAR) || '.log' AS file,
  CAST(o_orderkey % 1000 + 1 AS BIGINT) AS line_i, 'INFO' AS level_s,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS timestamp_tdt,
  CASE WHEN req THEN 'org.apache.solr.core.SolrCore' ELSE 'org.apache.solr.handler.component.SearchHandler' END AS category_s,
  'orders' AS collection_s, 'shard' || {_REQ_SHARD} AS shard_s,
  'core_node' || CAST(o_orderkey % 3 + 1 AS VARCHAR) AS replica_s, 'orders_shard' || {_REQ_SHARD} || '_replica1' AS core_s,
  CASE WHEN req THEN 'orders_shard' || {_REQ_SHARD} || '_replica1' END AS core_node_name_s,
  CASE WHEN req THEN 'solr' END AS webapp_s, CASE WHEN req THEN 'select' END AS path_s,
  CASE WHEN req THEN {_COLLAPSE.format(_REQ_PARAMS)} END AS params_s,
  CASE WHEN req THEN CAST(o_orderkey % 100 AS VARCHAR) END AS hits_i, CASE WHEN req THEN '0' END AS status_i,
  CASE WHEN req THEN CAST(o_custkey % 50 AS VARCHAR) END AS qtime_i,
  CASE WHEN req THEN 'order:' || CAST(o_orderkey AS VARCHAR) END AS q_s,
  CASE WHEN req THEN 'status:' || o_orderstatus END AS fq_s,
  CASE WHEN req THEN {_COLLAPSE.format('o_orderpriority')} END AS prio_s,
  CASE WHEN req THEN '10' END AS rows_s, CASE WHEN req THEN CAST(4 AS INTEGER) END AS n_params,
  {_COLLAPSE.format("'[orders_shard' || " + _REQ_SHARD + " || '_replica1] webapp=/solr path=/select params={' || " + _REQ_PARAMS + " || '} hits=' || CAST(o_orderkey % 100 AS VARCHAR) || ' status=0 QTime=' || CAST(o_custkey % 50 AS VARCHAR)")} AS message_txt_en
FROM r
"""


def page_params(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rec = solr_log(normalize_lines(R.page_request_lines_of(R.ordered_table(spark, d, "pages", "page_id"))), SEARCH_LOG)
    # explode_outer: a plain explode makes the optimizer add a size(params) > 0 filter that
    # re-evaluates the whole params expression below the generator
    out = rec.select("file", "line_i", F.explode_outer("params").alias("key", "value"))
    return out.where(F.col("key").isNotNull())


SQL_PAGE_PARAMS = """
WITH p AS (SELECT 'pages/part-' || CAST(page_id // 1000 AS VARCHAR) || '.log' AS file,
                  CAST(page_id % 1000 + 1 AS BIGINT) AS line_i, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages),
s AS (SELECT file, line_i, unnest(string_split(q, '&')) AS pair, unnest(range(1, len(string_split(q, '&')) + 1)) AS pos FROM p),
kv AS (SELECT file, line_i, pos, split_part(pair, '=', 1) AS k0, substr(pair, strpos(pair, '=') + 1) AS value
       FROM s WHERE strpos(pair, '=') > 0),
k AS (SELECT file, line_i, pos, CASE WHEN suffix(k0, '_s') THEN k0 ELSE k0 || '_s' END AS key, value FROM kv WHERE k0 <> '_')
SELECT file, line_i, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY file, line_i, key ORDER BY pos DESC) AS rk FROM k) WHERE rk = 1
"""


# --- P10: XML records, D1/D2 documents, multi-line statistics --------------------------------------
def _xml_records(spark, d, keep_empty=False):
    lines = normalize_lines(R.xml_lines_of(R.table(spark, d, "customer")))
    return xml_field_docs(lines, keep_empty=keep_empty)


def xml_docs(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    f = F.col("fields")
    return _xml_records(spark, d).select(
        "file", "line_i", "n_lines", f["id"].alias("id"), f["name"].alias("name"),
        f["nation"].cast("bigint").alias("nation"), f["balance"].cast("double").alias("balance"),
        f["segment"].alias("segment"))


_XML_FILE = "'xml/part-' || CAST(c_custkey // 100 AS VARCHAR) || '.xml'"
_XML_LINE_I = "CAST(2 + 7 * (row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1) AS BIGINT)"
SQL_XML = f"""
SELECT {_XML_FILE} AS file, {_XML_LINE_I} AS line_i, CAST(7 AS BIGINT) AS n_lines, CAST(c_custkey AS VARCHAR) AS id,
  c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance, c_mktsegment AS segment
FROM customer
"""


def documents_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return explode_documents(to_documents(_xml_records(spark, d)))


SQL_DOCUMENTS = f"""
WITH c AS (SELECT *, {_XML_FILE} AS file, {_XML_LINE_I} AS line_i FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS id, 'id' AS name, CAST(c_custkey AS VARCHAR) AS value FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'name', c_name FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR) FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'balance', CAST(c_acctbal AS VARCHAR) FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'line_i', CAST(line_i AS VARCHAR) FROM c
UNION ALL SELECT CAST(c_custkey AS VARCHAR), '_src_', file || ':' || CAST(line_i AS VARCHAR) FROM c
"""


def xml_file_stats(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    from ..functions.plan import materialize
    from ..operators.multiline import assemble_records, classify_xml
    from ..operators.stats import BLANK_STATE
    # every physical line classified once, blank ones kept as BLANK: two passes in all
    lines = normalize_lines(R.xml_lines_of(R.table(spark, d, "customer")), keep_blank=True)
    state, fields = classify_xml(F.col("line"))
    state = F.when(F.col("line") == "", F.lit(BLANK_STATE)).otherwise(state)
    classified = materialize(lines.select("file", "line_num", "line"), "__x",
                             F.struct(state.alias("state"), fields.alias("fields"))) \
        .select("file", "line_num", "__x.state", "__x.fields")
    records = assemble_records(classified, map_col="fields", keep_empty=True)
    return multiline_stats(classified, records)


SQL_XML_STATS = f"""
SELECT file, CAST(2 + 7 * COUNT(*) AS BIGINT) AS lines_read, CAST(7 * COUNT(*) AS BIGINT) AS lines_parsed,
  CAST(2 AS BIGINT) AS lines_skipped, CAST(COUNT(*) AS BIGINT) AS docs
FROM (SELECT {_XML_FILE} AS file FROM customer) GROUP BY file
"""


# --- K1: deterministic batches --------------------------------------------------------------------------
def batches(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    orders = R.table(spark, d, "orders")
    records = orders.select(
        F.concat(F.lit("orders/part-"), F.floor(F.col("o_orderkey") / 1000).cast("string"), F.lit(".log")).alias("file"),
        (F.col("o_orderkey") % 1000 + 1).cast("bigint").alias("line_num"),
        F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_totalprice", "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    # the batching key and the order travel next to each document
    docs = to_documents(records, fields=["id", "o_orderstatus", "o_totalprice", "o_orderpriority"], keep=["o_orderpriority", "o_orderkey"])
    b = batch_documents_by_key(docs, "o_orderpriority", "o_orderkey", n=100)
    return b.select("o_orderpriority", "batch_no", "n_docs", "first_order", "last_order")


SQL_BATCHES = """
WITH o AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority, o_orderkey FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM o)
SELECT o_orderpriority, CAST((rn - 1) // 100 AS BIGINT) AS batch_no, CAST(COUNT(*) AS INTEGER) AS n_docs,
  MIN(o_orderkey) AS first_order, MAX(o_orderkey) AS last_order
FROM r GROUP BY 1, 2
"""


# --- A1/A2: statistics of a single-line job -----------------------------------------------------------
def _access_stats(spark, d):
    lines = R.access_lines_by_day(_events(spark, d))
    # one pass: blank lines stay in the parsed table and are counted as blank
    parsed = grok_extract(normalize_lines(lines, keep_blank=True))
    return file_stats(status_of(parsed))


def file_stats_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return _access_stats(spark, d)


def run_stats_query(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return run_stats(_access_stats(spark, d))


_DAY_FILE = "'access/' || strftime(ts, '%Y-%m-%d') || '.log'"
SQL_FILE_STATS = f"""
SELECT {_DAY_FILE} AS file, COUNT(*) AS lines_read, COUNT(*) FILTER (WHERE event_type <> 'error') AS lines_parsed,
  COUNT(*) FILTER (WHERE event_type = 'error') AS lines_skipped,
  COUNT(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS docs
FROM events GROUP BY 1
"""
SQL_RUN_STATS = f"""
SELECT COUNT(*) AS files_total, COUNT(*) FILTER (WHERE docs > 0) AS files_with_docs, SUM(docs)::BIGINT AS docs,
  SUM(lines_read)::BIGINT AS lines_read, SUM(lines_parsed)::BIGINT AS lines_parsed, SUM(lines_skipped)::BIGINT AS lines_skipped
FROM ({SQL_FILE_STATS})
"""


# --- T2: tail offsets ------------------------------------------------------------------------------------
def tail_offsets(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    lines = R.conversation_lines_of(R.table(spark, d, "conversations"))
    offsets = lines.groupBy("file").agg(F.floor(F.count(F.lit(1)) / 2).cast("bigint").alias("last_line"))
    return after_offsets(lines, offsets).select("file", "line_num", "line")


SQL_TAIL = """
WITH c AS (SELECT *, COUNT(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT 'conv/' || CAST(conv_id AS VARCHAR) || '.log' AS file, CAST(turn + 1 AS BIGINT) AS line_num,
  role || ': ' || replace(text, chr(10), ' ') AS line
FROM c WHERE turn + 1 > n // 2
"""


# --- S1-S5: files on disk (plain and gzip), recursive scan, name filter, exact numbering -------------
def read_files(spark: SparkSession, d: str) -> DataFrame:
    """Writes the documents as text files (half gzip) below the shared checkpoint folder, reads
    them back with :func:`read_log_lines` and reports per source what was read."""
    prepare(spark)
    base = scratch_path(spark, f"read-files-{uuid.uuid4().hex}")
    docs = R.table(spark, d, "documents").select("source", "doc_id", "text")
    docs.where(F.col("doc_id") % 2 == 0).select("source", "text").write.partitionBy("source").text(f"{base}/plain")
    (docs.where(F.col("doc_id") % 2 == 1).select("source", "text").write.partitionBy("source")
     .option("compression", "gzip").text(f"{base}/gz"))
    lines = read_log_lines(spark, base, match=r".*\.txt(\.gz)?")
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_num").alias("lo"), F.max("line_num").alias("hi"),
        F.sum("line_num").alias("nd"),
        F.sum(F.when(F.trim(F.col("line"), F.lit("".join(chr(c) for c in range(33)))) != "", 1).otherwise(0)).alias("nonblank"),
        F.sum(F.length("line")).alias("chars"))
    per_file = per_file.withColumn("source", F.regexp_extract("file", r"/source=([^/]+)/", 1))
    return per_file.groupBy("source").agg(
        F.sum("n").cast("bigint").alias("lines_read"), F.sum("nonblank").cast("bigint").alias("nonblank"),
        F.sum("chars").cast("bigint").alias("chars"),
        F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("nd") * 2 == F.col("n") * (F.col("n") + 1))).alias("numbering_ok"))


SQL_READ_FILES = f"""
WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT source, COUNT(*) AS lines_read, COUNT(*) FILTER (WHERE {_TRIM.format('line')} <> '') AS nonblank,
  SUM(length(line))::BIGINT AS chars, true AS numbering_ok
FROM l GROUP BY source
"""


# --- T1: watching a directory (Structured Streaming file source, availableNow) -------------------
def stream_files(spark: SparkSession, d: str) -> DataFrame:
    """The documents as text files below the shared folder, picked up by :func:`watch_directory`
    (one availableNow run), numbered per micro-batch and written to a table; per source: what was
    read."""
    from ..streaming.watch import watch_directory

    prepare(spark)
    base = scratch_path(spark, f"stream-files-{uuid.uuid4().hex}")
    docs = R.table(spark, d, "documents").select("source", "text")
    docs.write.partitionBy("source").text(f"{base}/in")
    out = f"{base}/out"

    def handler(lines: DataFrame, batch_id: int) -> None:
        lines.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = watch_directory(spark, f"{base}/in", handler, f"{base}/checkpoint", match=r".*\.txt",
                        trigger={"availableNow": True})
    q.awaitTermination()
    lines = spark.read.parquet(out)
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_num").alias("lo"), F.max("line_num").alias("hi"),
        F.sum(F.when(F.trim(F.col("line"), F.lit("".join(chr(c) for c in range(33)))) != "", 1).otherwise(0)).alias("nonblank"),
        F.sum(F.length("line")).alias("chars"))
    per_file = per_file.withColumn("source", F.regexp_extract("file", r"/source=([^/]+)/", 1))
    return per_file.groupBy("source").agg(
        F.sum("n").cast("bigint").alias("lines_read"), F.sum("nonblank").cast("bigint").alias("nonblank"),
        F.sum("chars").cast("bigint").alias("chars"),
        F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("numbering_ok"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "apache_extract": (apache_extract, SQL_APACHE),
    "typed_captures": (typed_captures, SQL_TYPED),
    "unmatched_routing": (unmatched_routing, SQL_UNMATCHED),
    "ignore_before": (ignore_before_query, SQL_IGNORE_BEFORE),
    "json_lines": (json_lines_query, SQL_JSON),
    "raw_lines": (raw_lines_query, SQL_RAW),
    "skip_processed": (skip_processed_query, SQL_SKIP),
    "dns_extract": (dns_extract, SQL_DNS),
    "multiline_log": (multiline_log, SQL_MULTILINE),
    "solr_requests": (solr_requests, SQL_REQUESTS),
    "page_params": (page_params, SQL_PAGE_PARAMS),
    "xml_docs": (xml_docs, SQL_XML),
    "documents": (documents_query, SQL_DOCUMENTS),
    "xml_file_stats": (xml_file_stats, SQL_XML_STATS),
    "batches": (batches, SQL_BATCHES),
    "file_stats": (file_stats_query, SQL_FILE_STATS),
    "run_stats": (run_stats_query, SQL_RUN_STATS),
    "tail_offsets": (tail_offsets, SQL_TAIL),
    "read_files": (read_files, SQL_READ_FILES),
    "stream_files": (stream_files, SQL_READ_FILES),
    **FILE_QUERIES,
}
