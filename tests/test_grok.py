"""Grok compiler: expansion, group accounting, optional groups, catalog compiles in Spark."""

import pytest
from pyspark.sql import functions as F

from logweave.functions.grok import GrokError, PatternLibrary, default_library
from logweave.operators.extract import grok_extract

APACHE = '127.0.0.1 - frank [10/Oct/2000:13:55:36 -0700] "GET /apache_pb.gif HTTP/1.0" 200 2326'
COMBINED = APACHE + ' "http://www.example.com/start.html" "Mozilla/4.08 [en] (Win98; I ;Nav)"'


def test_group_numbers_and_optional():
    g = default_library().compile("%{COMMONAPACHELOG}")
    names = [(c.name, c.optional) for c in g.captures]
    assert names == [("clientip", False), ("ident", False), ("auth", False), ("timestamp", False),
                     ("verb", True), ("request", True), ("httpversion", True), ("rawrequest", True),
                     ("response", False), ("bytes", True)]
    # every plain group became non-capturing: group count equals capture count
    import re
    assert len(re.findall(r"(?<!\\)\((?!\?)", g.regex)) == len(g.captures)


def test_unknown_and_cyclic_patterns():
    lib = PatternLibrary({"A": "%{B}", "B": "%{A}", "C": "x"})
    with pytest.raises(GrokError, match="refers to itself"):
        lib.compile("%{A}")
    with pytest.raises(GrokError, match="not defined"):
        lib.compile("%{NOPE}")
    with pytest.raises(GrokError):
        lib.compile("")


def test_bare_alternation_is_wrapped():
    lib = PatternLibrary({"AB": "a|b"})
    g = lib.compile("x%{AB:v}y")
    assert g.regex == "x(a|b)y"


def test_inline_and_typed_captures(spark):
    lib = default_library()
    g = lib.compile("(?<word>[a-z]+)=%{INT:n:int} %{NUMBER:f:float}")
    assert [(c.name, c.cast) for c in g.captures] == [("word", None), ("n", "bigint"), ("f", "double")]
    df = spark.createDataFrame([("f", 1, "key=42 2.5"), ("f", 2, "nothing")], "file string, line_num bigint, line string")
    out = grok_extract(df, "(?<word>[a-z]+)=%{INT:n:int} %{NUMBER:f:float}").orderBy("line_num").collect()
    assert (out[0].word, out[0].n, out[0].f, out[0]._matched) == ("key", 42, 2.5, True)
    assert (out[1].word, out[1].n, out[1]._matched) == (None, None, False)


def test_apache_common_and_combined(spark):
    df = spark.createDataFrame([("f", 1, APACHE), ("f", 2, COMBINED)], "file string, line_num bigint, line string")
    r = grok_extract(df, "%{COMBINEDAPACHELOG}").orderBy("line_num").collect()
    assert r[0]._matched is False
    row = r[1]
    assert (row.clientip, row.ident, row.auth, row.timestamp, row.verb, row.request, row.httpversion,
            row.response, row.bytes) == ("127.0.0.1", "-", "frank", "10/Oct/2000:13:55:36 -0700", "GET",
                                         "/apache_pb.gif", "1.0", "200", "2326")
    # quoted-string captures lose their surrounding quotes
    assert row.referrer == "http://www.example.com/start.html"
    assert row.agent == "Mozilla/4.08 [en] (Win98; I ;Nav)"
    assert row.rawrequest is None


def test_find_semantics_and_separator_slow_path(spark):
    sep_line = 'x 1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a\u0001b HTTP/1.1" 200 5'
    df = spark.createDataFrame([("f", 1, "junk before " + APACHE), ("f", 2, sep_line)],
                               "file string, line_num bigint, line string")
    r = grok_extract(df).orderBy("line_num").collect()
    assert r[0]._matched and r[0].clientip == "127.0.0.1"
    assert r[1]._matched and r[1].request == "/a\u0001b" and r[1].bytes == "5"


def test_repeated_name_takes_first_non_empty(spark):
    lib = PatternLibrary({"W": "[a-z]+"})
    df = spark.createDataFrame([("f", 1, "a:b"), ("f", 2, ":c")], "file string, line_num bigint, line string")
    r = grok_extract(df, "%{W:x}?:%{W:x}", lib).orderBy("line_num").collect()
    assert [x.x for x in r] == ["a", "c"]


def test_whole_catalog_compiles_in_spark(spark):
    """Every bundled pattern expands and is accepted by Java's regex engine."""
    lib = default_library()
    exprs = []
    for name in lib.names():
        g = lib.compile("%{" + name + "}")
        exprs.append(F.lit("probe line 10.0.0.1").rlike(g.regex).alias(name[:100]))
    # one projection per 40 patterns keeps the generated code small
    for i in range(0, len(exprs), 40):
        spark.range(1).select(*exprs[i:i + 40]).collect()
    assert len(exprs) > 300


def test_pattern_library_sources(spark, tmp_path):
    p = tmp_path / "mine"
    p.write_text("# comment\nGREETING hello|hi\n\nNAME [A-Z][a-z]+\n")
    lib = PatternLibrary().add_file(str(p))
    assert lib.definitions == {"GREETING": "hello|hi", "NAME": "[A-Z][a-z]+"}
    lib2 = PatternLibrary().add_dataframe(spark.createDataFrame([("X", "x+")], "name string, regex string"))
    assert lib2.definitions == {"X": "x+"}


def test_required_literals_are_exact():
    from logweave.functions.grok import required_literals
    lib = default_library()
    assert {"; [", " - "} <= set(required_literals(lib.compile("%{SOLR_651_LOG4J}").regex))
    # alternation at the top, optional parts and counted quantifiers give no literal
    assert required_literals("a|b") == []
    assert required_literals("(?:x)?yz{2,3}") == ["y"]
    assert required_literals("(?i)abc") == []
    assert required_literals("(?=foo)bar") == ["bar"]
