"""Golden results per job (XML sample, search log, DNS, JSON, raw lines) and statistics."""

import os

from pyspark.sql import functions as F

from logweave.operators.documents import explode_documents, preview_documents, to_documents
from logweave.operators.extract import dns_log, grok_extract, grok_job, json_lines, raw_lines
from logweave.operators.multiline import CONT, END, SKIP, START, assemble_records, classify_xml, xml_field_docs
from logweave.operators.normalize import ignore_before, normalize_lines, route_unmatched, split_unmatched
from logweave.operators.solr import explode_params, solr_log, unpack_mdc
from logweave.operators.stats import file_stats, line_status, multiline_file_stats, run_stats, status_of
from logweave.sources.files import read_log_lines

from conftest import DATA

README_EXPR = ("%{LOGLEVEL:level_s} - %{TIMESTAMP_ISO8601:logdate}; \\[(?:%{DATA:mdc_s}| )\\] %{DATA:category_s}; "
               "\\[(?:%{DATA:core_s}| )\\] %{JAVALOGMESSAGE:logmessage}")


def test_normalize_java_trim(lines_of):
    df = lines_of({"f": "  a \t\r\n\n\x01\x02b\x1f\n   "})
    assert [(r.line_num, r.line) for r in normalize_lines(df).orderBy("line_num").collect()] == [(1, "a"), (3, "b")]


def test_xml_golden(spark):
    lines = read_log_lines(spark, DATA, match="*.xml")
    recs = xml_field_docs(normalize_lines(lines), chunk_lines=5)
    assert recs.count() == 6
    doc = to_documents(recs).where("id = '001'").first()
    names = [f.name for f in doc.fields]
    assert names == ["_src_", "city", "first name", "id", "last name", "line_i", "phone"]
    vals = {f.name: f.value for f in doc.fields}
    assert vals["line_i"] == "2" and vals["_src_"].endswith("people.xml:2") and vals["first name"] == "Ada"
    # statistics: 44 read, 42 parsed, 2 skipped, 6 docs
    state, _ = classify_xml(F.col("line"))
    norm = normalize_lines(lines)
    st = multiline_file_stats(lines, norm.select("file", "line_num", state.alias("state")),
                              xml_field_docs(norm, keep_empty=True)).first()
    assert (st.lines_read, st.lines_parsed, st.lines_skipped, st.docs) == (44, 42, 2, 6)
    assert "\"id\"" in preview_documents(to_documents(recs)).first().json
    # one-pass variant over lines classified with blanks kept
    from logweave.operators.stats import BLANK_STATE, multiline_stats
    all_lines = normalize_lines(lines, keep_blank=True)
    cls = all_lines.select("file", "line_num", F.when(F.col("line") == "", F.lit(BLANK_STATE)).otherwise(state).alias("state"),
                           classify_xml(F.col("line"))[1].alias("fields"))
    st2 = multiline_stats(cls, assemble_records(cls, map_col="fields", keep_empty=True)).first()
    assert (st2.lines_read, st2.lines_parsed, st2.lines_skipped, st2.docs) == (44, 42, 2, 6)


def test_multiline_rules(spark):
    """START after START, END without START, SKIP inside a record, orphan head, open record at
    end of file, failed line ignored - independent of chunk size."""
    states = [CONT, CONT, START, SKIP, CONT, END, END, START, START, CONT, None, CONT]
    rows = [("f", i + 1, s, f"v{i + 1}" if s in (CONT, END) else None) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, "file string, line_num bigint, state string, v string")
    for chunk in (1, 2, 3, 1000):
        recs = assemble_records(df, fields=["v"], chunk_lines=chunk, keep_empty=True).orderBy("first_line").collect()
        got = [(r.line_i, r.first_line, r.n_lines, r.has_end, r.v, r.emitted) for r in recs]
        assert got == [
            (None, 1, 2, False, "v2", True),      # orphan head (lines 1-2)
            (3, 3, 3, True, "v6", True),          # START, (SKIP), CONT, END
            (None, 7, 1, True, "v7", True),       # END carrying a field: emitted
            (8, 8, 1, False, None, True),         # START directly after START
            (9, 9, 3, False, "v12", True),        # open at end of file; failed line 11 ignored
        ], chunk


def test_empty_end_is_skipped(spark):
    rows = [("f", 1, START, None), ("f", 2, END, None), ("f", 3, END, None), ("f", 4, SKIP, None)]
    df = spark.createDataFrame(rows, "file string, line_num bigint, state string, v string")
    recs = assemble_records(df, fields=["v"], keep_empty=True).orderBy("first_line").collect()
    assert [(r.emitted, r.has_end, r.n_lines) for r in recs] == [(True, True, 2), (False, True, 1)]


def test_search_log_bundled_expression(spark):
    lines = normalize_lines(read_log_lines(spark, DATA, match="search.log"))
    recs = solr_log(lines, "%{SOLR_651_LOG4J}", chunk_lines=4).orderBy("line_i").collect()
    assert [r.line_i for r in recs] == [1, 2, 3, 4, 5, 22]
    r5 = recs[4]
    assert r5.n_lines == 17 and r5.level_s == "ERROR"
    assert r5.message_txt_en.startswith('com.acme.search.QueryFault: no such column: "petals" at ')
    assert r5.message_txt_en.endswith("Gateway.java:226)") and "  " not in r5.message_txt_en
    r6 = recs[5]
    expect = dict(collection_s="herbarium", shard_s="shard4", replica_s="core_node9",
                  core_s="herbarium_shard4_replica2", webapp_s="solr", path_s="select", hits_i="17",
                  status_i="400", qtime_i="26", timestamp_tdt="2021-03-14T07:03:07.659Z")
    assert {k: getattr(r6, k) for k in expect} == expect
    assert r6.logdate is None  # replaced by the ISO timestamp
    assert r6.params == {"q_s": "genus:rosa", "group.by_s": "petals", "lines_s": "on", "group_s": "on", "wt_s": "json"}
    # the admin requests are not request categories: no request fields
    assert recs[0].params is None and recs[0].webapp_s is None
    docs = {d.id: {f.name: f.value for f in d.fields} for d in to_documents(solr_log(lines, "%{SOLR_651_LOG4J}")).collect()}
    d6 = [v for k, v in docs.items() if k.endswith(":22")][0]
    assert d6["q_s"] == "genus:rosa" and d6["line_i"] == "22" and "params" not in d6


def test_search_log_readme_expression(spark):
    lines = normalize_lines(read_log_lines(spark, DATA, match="search.log"))
    recs = solr_log(lines, README_EXPR).orderBy("line_i").collect()
    assert [r.line_i for r in recs] == [1, 2, 4, 22]
    assert recs[1].message_txt_en.endswith("Shelf check done with options depth=2&mode=quick")


def test_search_log_orphan_head(spark, lines_of):
    df = normalize_lines(lines_of({"f": "just text\n  more   text\n"}))
    recs = solr_log(df, "%{SOLR_651_LOG4J}").collect()
    assert len(recs) == 1 and recs[0].orphan and recs[0].message_txt_en == " just text more text"
    assert to_documents(solr_log(df, "%{SOLR_651_LOG4J}")).first().id == "f:1"


def test_mdc_and_params(spark):
    df = spark.createDataFrame([("c:col s:sh1 bad x:core:extra r:rep x:c2",), (None,)], "mdc_s string")
    r = unpack_mdc(df).collect()
    assert (r[0].collection_s, r[0].shard_s, r[0].replica_s, r[0].core_s) == ("col", "sh1", "rep", "c2")
    assert r[1].collection_s is None
    p = spark.createDataFrame([("a=1&b&_=9&c_s=x=y&a=2&=e",)], "params_s string").select(
        explode_params(F.col("params_s")).alias("m")).first().m
    assert p == {"a_s": "2", "c_s": "x=y", "_s": "e"}


def test_dns_golden(spark, lines_of):
    line = ("Dec 09 00:00:00 HOST-1 MSWinEventLog|1|Application|12|Wed Dec 09 00:00:00 2015|3|Lucent DNS Service|"
            "N/A|N/A|Information|HOST-1|None||client 10.1.2.3#5353: query: www.example.com IN A")
    one_digit = line.replace("Dec 09 00:00:00 2015", "Dec  9 07:08:09 2015")
    rows = dns_log(lines_of({"d": line + "\n" + one_digit})).orderBy("line_num").collect()
    assert [(r.timestamp, r.host, r.client, r.query, r.type, r._matched) for r in rows] == [
        ("2015-12-09T00:00:00.000Z", "HOST-1", "10.1.2.3", "www.example.com", "A", True),
        ("2015-12-09T07:08:09.000Z", "HOST-1", "10.1.2.3", "www.example.com", "A", True)]


def test_json_edge_cases(lines_of):
    text = '{"a":1,"b":{"c":[1,2]},"a":3,"n":null}\n[1,2]\nnull\n{bad\n"x"\n{}'
    rows = json_lines(lines_of({"j": text})).orderBy("line_num").collect()
    assert [r._matched for r in rows] == [True, False, False, False, False, True]
    assert sorted(rows[0].fields.keys()) == ["a", "b"]
    docs = to_documents(json_lines(lines_of({"j": '{"id":"k1","v":2.5,"o":{"x":1}}'})).where("_matched"))
    d = docs.first()
    assert d.id == "k1" and {f.name: f.value for f in d.fields} == {"_src_": "j:1", "id": "k1", "o": '{"x":1}', "v": "2.5"}


def test_raw_lines_and_ids(lines_of):
    r = raw_lines(normalize_lines(lines_of({"/x/a.log": "one\n\ntwo"}))).orderBy("line_num").collect()
    assert [(x.id, x._raw_content_) for x in r] == [("/x/a.log:1", "one"), ("/x/a.log:3", "two")]


def test_documents_rules(spark):
    recs = spark.createDataFrame([("f", 7, "X1", "Val", None), ("f", 8, None, "v", "w")],
                                 "file string, line_num bigint, id string, Upper string, n string")
    d = {r.id: [(f.name, f.value) for f in r.fields] for r in to_documents(recs).collect()}
    assert d == {"X1": [("_src_", "f:7"), ("id", "X1"), ("upper", "Val")], "f:8": [("n", "w"), ("upper", "v")]}
    assert explode_documents(to_documents(recs)).count() == 5


def test_routing_and_counters(spark, lines_of):
    good = '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET / HTTP/1.1" 200 1'
    lines = lines_of({"f": "\n".join([good, "", "garbage", good, "   "])})
    parsed = grok_job(normalize_lines(lines), timestamp_field="ts", date_field="timestamp",
                      date_format="dd/MMM/yyyy:HH:mm:ss Z", unmatched_line_name="unmatched")
    assert parsed.where("unmatched is not null").first().unmatched == "garbage"
    assert parsed.where("_matched").first().ts == "2000-10-10T20:55:36.000Z"
    plain = grok_extract(normalize_lines(lines))
    st = file_stats(line_status(lines, plain)).first()
    assert (st.lines_read, st.lines_parsed, st.lines_skipped, st.docs) == (5, 4, 1, 2)
    assert st.lines_read == st.lines_parsed + st.lines_skipped
    one_pass = file_stats(status_of(grok_extract(normalize_lines(lines, keep_blank=True)))).first()
    assert one_pass == st
    tot = run_stats(file_stats(line_status(lines, plain))).first()
    assert (tot.files_total, tot.docs, tot.lines_skipped) == (1, 2, 1)
    matched, rejected = split_unmatched(grok_job(normalize_lines(lines), unmatched_line_name="u"))
    assert rejected.count() == 1 and matched.count() == 2


def test_ignore_before(spark):
    df = spark.sql("select * from values (timestamp'2024-01-01 00:00:00'), (timestamp'2024-02-01 00:00:00'), "
                   "(cast(null as timestamp)) as t(ts)")
    assert ignore_before(df, "2024-01-15T00:00:00").count() == 2


def test_observed_run_stats(lines_of):
    from logweave.operators.stats import observe_run
    good = '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET / HTTP/1.1" 200 1'
    lines = lines_of({"f": "\n".join([good, "", "garbage", good])})
    st = status_of(grok_extract(normalize_lines(lines, keep_blank=True)))
    out, obs = observe_run(st)
    assert out.where("status = 'doc'").count() == 2       # the sink's own action
    assert obs.get == {"lines_read": 4, "lines_parsed": 3, "lines_skipped": 1, "docs": 2}


def test_search_log_split_invariance(spark):
    """Tiny file splits and tiny chunks give the same records as one split and one chunk."""
    def records(max_bytes, chunk):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
        try:
            lines = normalize_lines(read_log_lines(spark, DATA, match="search.log"))
            return sorted((r.line_i, r.n_lines, r.message_txt_en) for r in
                          solr_log(lines, "%{SOLR_651_LOG4J}", chunk_lines=chunk).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert records("300", 2) == records("134217728", 1 << 20)
