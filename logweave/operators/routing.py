"""Logs in which lines of several kinds are mixed: each line goes to the first expression that matches it (P2).

Trying every expression of a catalog on every line costs as many regex searches as there are expressions.  Most
expressions need some literal text, though.  An index from the longest literal of each expression to the
expressions that have it as theirs is looked up first: only where the literal occurs in the line (and the other
needed ones too) is the regex run, and the least number of a matching expression wins.  Expressions without a
needed literal are tried on every line, in order.  All of it is one expression per line, without Python."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grok import Grok, PatternLibrary, compile_grok, required_literals
from ..functions.plan import materialize


def literal_index(groks: list[Grok]) -> dict[str | None, list[int]]:
    """Longest needed literal -> numbers of the expressions, in order; None: those that need none."""
    index: dict[str | None, list[int]] = {}
    for i, grok in enumerate(groks):
        index.setdefault(next(iter(required_literals(grok.regex)), None), []).append(i)
    return index


def choice(line: Column, groks: list[Grok]) -> Column:
    """The number of the first expression that matches ``line``, or null."""
    firsts = []
    for literal, numbers in literal_index(groks).items():
        tests = None
        for i in numbers:
            possible = groks[i].possible(line)
            hit = line.rlike(groks[i].regex) if possible is None else possible & line.rlike(groks[i].regex)
            tests = F.when(hit, F.lit(i)) if tests is None else tests.when(hit, F.lit(i))
        firsts.append(tests if literal is None else F.when(F.instr(line, F.lit(literal)) > 0, tests))
    return F.least(*firsts) if len(firsts) > 1 else firsts[0]


def route_lines(lines: DataFrame, expressions: Mapping[str, str], library: PatternLibrary | None = None, line_col: str = "line",
                keep_unnamed=()) -> DataFrame:
    """All rows of ``lines`` plus ``expression``, the name of the first of ``expressions`` (name -> grok expression, in
    order) that matches, and ``fields``, its captures that are not null as ``MAP<STRING,STRING>``; both null where none
    matches or the line is null.  Columns of these names give way.  Each line is searched by the expressions whose needed
    literals it has, and taken apart by the one that is chosen."""
    if not expressions:
        raise ValueError("no expressions")
    names = list(expressions)
    groks = [compile_grok(expressions[n], library, keep_unnamed=keep_unnamed) for n in names]
    lines = lines.drop("expression", "fields")
    chosen = materialize(lines, "__choice", choice(F.col(line_col), groks))
    number, line = F.col("__choice"), F.col(line_col)
    apart = named = maps = None
    for i, grok in enumerate(groks):
        apart = F.when(number == i, grok.parts(line)) if apart is None else apart.when(number == i, grok.parts(line))
    parted = materialize(chosen, "__parts", apart)
    for i, (name, grok) in enumerate(zip(names, groks)):
        pairs = [x for field, value in grok.values(F.col("__parts")).items() for x in (F.lit(field), value.cast("string"))]
        fields = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
        maps = F.when(number == i, fields) if maps is None else maps.when(number == i, fields)
        named = F.when(number == i, F.lit(name)) if named is None else named.when(number == i, F.lit(name))
    return parted.select(*[F.col(f"`{c}`") for c in lines.columns], named.alias("expression"), maps.alias("fields"))
