"""Render the driver's tables as log text ``lines(file, line_num, line)``.

These give every job real input whose size grows with the tables; the DuckDB oracles select the
same values straight from the source columns.  Files are cut by key ranges (bounded number of
records per file), so numbering a file never needs a window over a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table.  Where Spark would read it in fewer tasks than the session has cores (the test
    tables are one file with one row group each), it is spread round-robin so the parsing that
    follows uses every core; a larger table is left as it is."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


#: Rows of a table that one task renders and sums up, about.
TASK_ROWS = 250_000


def ordered_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A source table in ranges of ``key``, in order: tasks of about ``TASK_ROWS`` rows, as many as the session has cores at
    least.  Lines rendered from it lie in their files' order, as read files do, and what a task holds of them
    does not grow with the table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))  # counted from the footers
    return df.repartitionByRange(tasks, key).sortWithinPartitions(key)


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- events as an access log -------------------------------------------------------------------
def event_ip(event_id: Column) -> Column:
    return F.concat_ws(".", F.lit("10"), _s(F.floor(event_id / 65536) % 256), _s(F.floor(event_id / 256) % 256),
                       _s(event_id % 256))


def access_line(broken_errors: bool = False, blank_signups: bool = False) -> Column:
    """COMMONAPACHELOG line of one event.  ``view`` events have no byte count (``-``), ``click``
    events no protocol, ``error`` events a raw request (or, with ``broken_errors``, a line that
    matches nothing), ``signup`` events optionally a blank line."""
    et, eid = F.col("event_type"), F.col("event_id")
    verb = F.when(et == "purchase", "POST").when(et == "signup", "PUT").otherwise("GET")
    request = F.concat(F.lit("/"), et, F.lit("/"), _s(eid), F.lit("?user="), _s("user_id"))
    req = (F.when(et == "error", F.lit("BAD-REQUEST"))
           .when(et == "click", F.concat(verb, F.lit(" "), request))
           .otherwise(F.concat(verb, F.lit(" "), request, F.lit(" HTTP/1.1"))))
    status = F.when(et == "error", F.lit("500")).otherwise(F.lit("200"))
    nbytes = F.when(et == "view", F.lit("-")).otherwise(_s(eid * 7 + F.col("user_id")))
    line = F.concat(event_ip(eid), F.lit(" - user"), _s("user_id"), F.lit(" ["),
                    F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""), req, F.lit("\" "),
                    status, F.lit(" "), nbytes)
    if broken_errors:
        line = F.when(et == "error", F.concat(F.lit("ERROR event "), _s(eid), F.lit(" for user "), _s("user_id"))).otherwise(line)
    if blank_signups:
        line = F.when(et == "signup", F.lit("   ")).otherwise(line)
    return line


def events_file() -> Column:
    return F.concat(F.lit("events/part-"), _s(F.floor(F.col("event_id") / 10000)), F.lit(".log"))


def events_line_num() -> Column:
    return (F.col("event_id") % 10000 + 1).cast("bigint")


def access_lines(events: DataFrame, **kw) -> DataFrame:
    return events.select(events_file().alias("file"), events_line_num().alias("line_num"),
                         access_line(**kw).alias("line"))


def access_lines_by_day(events: DataFrame) -> DataFrame:
    """One file per day; errors broken, signups blank (for the statistics)."""
    return events.select(F.concat(F.lit("access/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".log")).alias("file"),
                         F.col("event_id").cast("bigint").alias("line_num"),
                         access_line(broken_errors=True, blank_signups=True).alias("line"))


# --- events as JSON lines ------------------------------------------------------------------------
def json_line() -> Column:
    good = F.concat(F.lit('{"event_id":'), _s("event_id"), F.lit(',"type":"'), F.col("event_type"),
                    F.lit('","user":{"id":'), _s("user_id"), F.lit('},"value":'), _s("value"),
                    F.lit(',"props":'), F.col("props"), F.lit(',"note":null}'))
    return F.when(F.col("event_type") == "signup", F.concat(F.lit('{"event_id": '), _s("event_id"))).otherwise(good)


def json_lines_of(events: DataFrame) -> DataFrame:
    return events.select(events_file().alias("file"), events_line_num().alias("line_num"), json_line().alias("line"))


# --- events as a DNS server log ------------------------------------------------------------------
def dns_line() -> Column:
    eid = F.col("event_id")
    host = F.concat(F.lit("dns"), _s(F.col("user_id") % 8), F.lit(".corp"))
    client = F.concat(F.lit("10.1."), _s(F.floor(eid / 256) % 256), F.lit("."), _s(eid % 256))
    qtype = F.when(F.col("event_type") == "purchase", F.lit("AAAA")).otherwise(F.lit("A"))
    return F.concat(
        F.date_format("ts", "MMM dd HH:mm:ss"), F.lit(" "), host, F.lit(" MSWinEventLog|1|Application|"), _s(eid),
        F.lit("|"), F.date_format("ts", "EEE MMM dd HH:mm:ss yyyy"),
        F.lit("|3|Lucent DNS Service|N/A|N/A|Information|"), host, F.lit("|None||client "), client,
        F.lit("#"), _s(1024 + eid % 5000), F.lit(": query: "), F.col("event_type"), _s(eid),
        F.lit(".example.com IN "), qtype)


def dns_lines_of(events: DataFrame) -> DataFrame:
    return events.select(events_file().alias("file"), events_line_num().alias("line_num"), dns_line().alias("line"))


# --- lineitem as an ELB access log ---------------------------------------------------------------
def elb_line() -> Column:
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    backend = F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(
        F.concat(F.lit("192.168.1."), _s(ln), F.lit(":"), _s(8000 + ln)))
    return F.concat(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(" elb-"), _s("l_suppkey"),
        F.lit(" 10.0."), _s(F.floor(pk / 256) % 256), F.lit("."), _s(pk % 256), F.lit(":"), _s(1000 + ln),
        F.lit(" "), backend, F.lit(" "), _s("l_discount"), F.lit(" "), _s("l_tax"), F.lit(" "), _s("l_quantity"),
        F.lit(" 200 "), _s(200 + ln), F.lit(" "), _s("l_orderkey"), F.lit(" "), _s("l_partkey"),
        F.lit(' "GET http://shop.example.com:80/orders/'), _s("l_orderkey"), F.lit("?line="), _s(ln),
        F.lit(' HTTP/1.1"'))


def elb_lines_of(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.lit("elb/part-"), _s(F.floor(F.col("l_orderkey") / 1000)), F.lit(".log")).alias("file"),
        ((F.col("l_orderkey") % 1000) * 8 + F.col("l_linenumber")).cast("bigint").alias("line_num"),
        elb_line().alias("line"))


# --- documents as raw text files ----------------------------------------------------------------
def doc_file() -> Column:
    return F.concat(F.lit("docs/"), F.col("source"), F.lit("/"), _s("doc_id"), F.lit(".txt"))


def text_lines_of(documents: DataFrame) -> DataFrame:
    """Every physical line of every document (blank ones included), one file per document."""
    return documents.select(doc_file().alias("file"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
        .select("file", (F.col("pos") + 1).cast("bigint").alias("line_num"), "line")


# --- documents as a search-server log with multi-line entries ------------------------------------
SOLR_DOCS_PER_FILE = 64


def solr_doc_lines(documents: DataFrame) -> DataFrame:
    """Per document a header line (a START) followed by the document's lines (continuations).
    Files hold up to 64 documents; their line offsets come from a window over at most 64 rows."""
    docs = documents.select(
        "doc_id", "source", "lang",
        F.concat(F.lit("solr/"), F.col("source"), F.lit("/part-"), _s(F.floor(F.col("doc_id") / SOLR_DOCS_PER_FILE)),
                 F.lit(".log")).alias("file"),
        F.split("text", "\n", -1).alias("parts"))
    w = Window.partitionBy("file").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("offset", F.coalesce(F.sum(F.size("parts") + 1).over(w), F.lit(0)))
    shard = _s(F.col("doc_id") % 4 + 1)
    ts = F.date_format(F.timestamp_seconds(F.lit(1496275200) + F.col("doc_id")), "yyyy-MM-dd HH:mm:ss.SSS")
    header = F.concat(
        F.lit("INFO  - "), ts, F.lit("; [c:"), F.col("source"), F.lit(" s:shard"), shard, F.lit(" r:core_node"),
        _s(F.col("doc_id") % 3 + 1), F.lit(" x:"), F.col("source"), F.lit("_shard"), shard,
        F.lit("_replica1] org.apache.solr.update.processor.LogUpdateProcessorFactory; doc "), _s("doc_id"),
        F.lit(" lang="), F.col("lang"))
    head = docs.select("file", (F.col("offset") + 1).cast("bigint").alias("line_num"), header.alias("line"))
    body = docs.select("file", "offset", F.posexplode("parts").alias("pos", "line")).select(
        "file", (F.col("offset") + 2 + F.col("pos")).cast("bigint").alias("line_num"), "line")
    return head.unionByName(body)


# --- orders as request log lines ------------------------------------------------------------------
def request_line() -> Column:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    shard = _s(ck % 4 + 1)
    category = F.when(F.col("o_orderstatus") == "P", F.lit("org.apache.solr.handler.component.SearchHandler")) \
        .otherwise(F.lit("org.apache.solr.core.SolrCore"))
    params = F.concat(F.lit("q=cust:"), _s(ck), F.lit("&fq=status:"), F.col("o_orderstatus"), F.lit("&prio="),
                      F.col("o_orderpriority"), F.lit("&_=1496325493119&rows=10&flag&q=order:"), _s(ok))
    return F.concat(
        F.lit("INFO  - "), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("; [c:orders s:shard"), shard,
        F.lit(" r:core_node"), _s(ok % 3 + 1), F.lit(" x:orders_shard"), shard, F.lit("_replica1] "), category,
        F.lit("; [orders_shard"), shard, F.lit("_replica1]  webapp=/solr path=/select params={"), params,
        F.lit("} hits="), _s(ok % 100), F.lit(" status=0 QTime="), _s(ck % 50))


def request_lines_of(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.concat(F.lit("requests/part-"), _s(F.floor(F.col("o_orderkey") / 1000)), F.lit(".log")).alias("file"),
        (F.col("o_orderkey") % 1000 + 1).cast("bigint").alias("line_num"),
        request_line().alias("line"))


def page_request_lines_of(pages: DataFrame) -> DataFrame:
    """One request line per page; its params are the URL's query string."""
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    line = F.concat(F.lit("INFO  - 2017-06-01 00:00:00.000; [c:web] org.apache.solr.core.SolrCore; [web] "
                          "webapp=/solr path=/select params={"), query, F.lit("} hits=1 status=0 QTime=1"))
    return pages.select(
        F.concat(F.lit("pages/part-"), _s(F.floor(F.col("page_id") / 1000)), F.lit(".log")).alias("file"),
        (F.col("page_id") % 1000 + 1).cast("bigint").alias("line_num"), line.alias("line"))


# --- customers as XML field records ------------------------------------------------------------
XML_DOCS_PER_FILE = 100


def xml_lines_of(customer: DataFrame) -> DataFrame:
    """``<add>``, per customer a ``<doc>`` block of five fields, ``</add>``; 100 customers per
    file (window over at most 100 rows)."""
    c = customer.withColumn("file", F.concat(F.lit("xml/part-"), _s(F.floor(F.col("c_custkey") / XML_DOCS_PER_FILE)),
                                             F.lit(".xml")))
    w = Window.partitionBy("file").orderBy("c_custkey")
    c = c.withColumn("r", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("file")))
    block = F.array(
        F.lit("  <doc>"),
        F.concat(F.lit('    <field name="id">'), _s("c_custkey"), F.lit("</field>")),
        F.concat(F.lit('    <field name = "name">'), F.col("c_name"), F.lit("</field>")),
        F.concat(F.lit('    <field name="nation">'), _s("c_nationkey"), F.lit("</field>")),
        F.concat(F.lit('    <field name="balance">'), _s("c_acctbal"), F.lit("</field>")),
        F.concat(F.lit('    <field name="segment">'), F.col("c_mktsegment"), F.lit("</field>")),
        F.lit("  </doc>"))
    body = c.select("file", (F.col("r") * 7 + 2).alias("base"), F.posexplode(block).alias("pos", "line")) \
        .select("file", (F.col("base") + F.col("pos")).cast("bigint").alias("line_num"), "line")
    first = c.where(F.col("r") == 0).select("file", F.lit(1).cast("bigint").alias("line_num"), F.lit("<add>").alias("line"))
    last = c.where(F.col("r") == F.col("n") - 1).select(
        "file", (F.col("n") * 7 + 2).cast("bigint").alias("line_num"), F.lit("</add>").alias("line"))
    return first.unionByName(body).unionByName(last)


# --- conversations as growing logs --------------------------------------------------------------
def conversation_lines_of(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.concat(F.lit("conv/"), _s("conv_id"), F.lit(".log")).alias("file"),
        (F.col("turn") + 1).cast("bigint").alias("line_num"),
        F.concat(F.col("role"), F.lit(": "), F.translate("text", "\n", " ")).alias("line"))
