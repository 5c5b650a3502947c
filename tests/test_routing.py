"""Mixed logs: the index gives what trying all expressions gives (P2)."""

import pytest
from pyspark.sql import functions as F

from logweave.functions.grok import compile_grok
from logweave.operators.routing import literal_index, route_lines

EXPRESSIONS = {
    "access": "%{COMMONAPACHELOG}", "order": "%{SYSLOGBASE} order %{INT:order:int} status=%{WORD:status}", "any order": "order %{INT:order}( by %{WORD:who})?",
    "level": "^%{LOGLEVEL:level} ", "number": "%{INT:n}", "quoted": "say %{QUOTEDSTRING:said}", "nothing": "order",
}
LINES = ['1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /order HTTP/1.0" 200 23', "Jun  1 00:00:07 host app[12]: order 42 status=O", "order 7 by me", "order 8", "an order",
         "WARN order 9", "WARN nothing", "x 5 y", "", None, "say 'a b' 3", 'say "q"', "sep\x01 order 11", "INFO x\x01y 3", "no match here", "status= order 5 status=", "order 42 status=O"]


def test_equal_to_trying_all(spark):
    lines = spark.createDataFrame(list(enumerate(LINES)), "line_num int, line string").withColumn("fields", F.lit(1))
    got = {r.line_num: (r.expression, r.fields) for r in route_lines(lines, EXPRESSIONS).collect()}
    want = {i: (None, None) for i in range(len(LINES))}
    for name, expression in reversed(EXPRESSIONS.items()):
        grok = compile_grok(expression)
        for r in grok.apply(lines.drop("fields")).where("_matched").collect():
            want[r.line_num] = (name, {f: str(r[f]) for f in grok.fields if r[f] is not None})
    assert got == want
    assert {e for e, _ in got.values()} == {None, *EXPRESSIONS} - {"nothing"} | {"nothing"}


def test_index():
    index = literal_index([compile_grok(e) for e in EXPRESSIONS.values()])
    assert sorted(i for numbers in index.values() for i in numbers) == list(range(len(EXPRESSIONS))) and None in index and len(index) >= 4


def test_catalog_of_presets(spark):
    presets = {n: f"%{{{n}}}" for n in ("COMBINEDAPACHELOG", "COMMONAPACHELOG", "HAPROXYHTTP", "SYSLOG5424LINE", "SYSLOGLINE", "REDISLOG", "MONGO3_LOG", "NAGIOSLOGLINE", "CATALINALOG")}
    lines = spark.createDataFrame([(LINES[0] + ' "r" "agent"',), (LINES[0],), (LINES[1],), ("[1427925600] SERVICE ALERT: a;b;OK;HARD;1;fine",), ("zzz",)], "line string")
    got = [r.expression for r in route_lines(lines, presets).collect()]
    assert got[:4] == ["COMBINEDAPACHELOG", "COMMONAPACHELOG", "SYSLOGLINE", "NAGIOSLOGLINE"] and got[4] is None
    with pytest.raises(ValueError):
        route_lines(lines, {})
