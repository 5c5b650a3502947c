"""Grok expressions compiled for Spark.

A grok expression (``%{NAME:field:type}`` references into a pattern library, plus plain regex) is
expanded once on the driver into a single Java regular expression whose only capturing groups are
the named captures, numbered left to right.  Executors then evaluate ordinary Spark SQL regex
functions against that literal pattern, so matching stays inside whole-stage codegen and the
pattern is compiled once per task.

Matching follows ``Matcher.find``: the first (leftmost) match anywhere in the line.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .plan import materialize

_PATTERN_DIR = os.path.join(os.path.dirname(__file__), "patterns")
_REF = re.compile(r"%\{(?P<name>\w+)(?::(?P<alias>[^:}]+))?(?::(?P<type>\w+))?\}")
_INLINE_NAME = re.compile(r"\(\?<([a-zA-Z][a-zA-Z0-9]*)>")
_ZERO_MIN = re.compile(r"\{\s*0*\s*[,}]|\{\s*0+\s*,")
_MARK = "(?<__c"

SEP = "\u0001"      # field separator inside the one-pass result
HIT = "\u0002"      # first element of the one-pass result when the line matched

# Bundled patterns whose matches can never start with a quote character (read off
# their definitions), so quote stripping is skipped for captures of them.
NO_LEADING_QUOTE = frozenset("""
INT BASE10NUM NUMBER BASE16NUM BASE16FLOAT POSINT NONNEGINT WORD USERNAME USER EMAILLOCALPART
EMAILADDRESS HTTPDUSER UUID MAC CISCOMAC WINDOWSMAC COMMONMAC IPV6 IPV4 IP HOSTNAME IPORHOST HOSTPORT
MONTH MONTHNUM MONTHNUM2 MONTHDAY DAY YEAR HOUR MINUTE SECOND TIME DATE_US DATE_EU ISO8601_TIMEZONE
ISO8601_SECOND TIMESTAMP_ISO8601 DATE DATESTAMP TZ DATESTAMP_RFC822 DATESTAMP_RFC2822 DATESTAMP_OTHER
DATESTAMP_EVENTLOG HTTPDERROR_DATE SYSLOGTIMESTAMP HTTPDATE LOGLEVEL URIPROTO
""".split())

# Exact rewrites: a lookahead that every match of the bundled definition satisfies, so the
# engine skips the long alternation where it cannot match (every IPv6 form starts with up to four
# hex digits and a colon).
_GUARDS = {"IPV6": "(?=[0-9A-Fa-f]{0,4}:)"}

_TYPES = {"int": "bigint", "long": "bigint", "integer": "bigint", "float": "double", "double": "double",
          "string": None, "str": None}


class GrokError(ValueError):
    pass


def bundled_set_names() -> list[str]:
    return sorted(n for n in os.listdir(_PATTERN_DIR) if not n.startswith("."))


MAX_DEFINITIONS = 100_000


class PatternLibrary:
    """Name → regex definitions.  Later definitions replace earlier ones."""

    def __init__(self, definitions: dict[str, str] | None = None):
        self.definitions: dict[str, str] = dict(definitions or {})

    # -- loading -------------------------------------------------------------------------------
    @classmethod
    def bundled(cls, sets: list[str] | None = None, base: str = "grok-patterns") -> "PatternLibrary":
        """All bundled sets (or the named ones) sorted by name, then ``base`` again so that its
        definitions win: directory first, pattern file last."""
        lib = cls()
        for name in sets if sets is not None else bundled_set_names():
            lib.add_file(os.path.join(_PATTERN_DIR, name))
        if base:
            lib.add_file(os.path.join(_PATTERN_DIR, base))
        return lib

    def add_file(self, path: str) -> "PatternLibrary":
        if path.startswith("patterns/"):
            path = os.path.join(_PATTERN_DIR, path[len("patterns/"):])
        with open(path, encoding="utf-8") as fh:
            return self.add_text(fh.read())

    def add_dir(self, path: str) -> "PatternLibrary":
        for name in sorted(os.listdir(path)):
            full = os.path.join(path, name)
            if os.path.isfile(full):
                self.add_file(full)
        return self

    def add_text(self, text: str) -> "PatternLibrary":
        for raw in text.splitlines():
            line = raw.lstrip()  # a blank at the end of a definition is part of it
            if not line or line.startswith("#"):
                continue
            parts = line.split(None, 1)
            if len(parts) == 2:
                self.definitions[parts[0]] = parts[1]
        return self

    def add(self, name: str, regex: str) -> "PatternLibrary":
        self.definitions[name] = regex
        return self

    def add_dataframe(self, df: DataFrame, name_col: str = "name", regex_col: str = "regex") -> "PatternLibrary":
        """Definitions from a (name, regex) table.  A pattern library is configuration, a few
        hundred rows at most, so it is fetched to the driver where expressions are compiled."""
        rows = df.select(name_col, regex_col).limit(MAX_DEFINITIONS + 1).collect()
        if len(rows) > MAX_DEFINITIONS:
            raise ValueError(f"a pattern library has at most {MAX_DEFINITIONS} definitions")
        for row in rows:
            self.definitions[row[0]] = row[1]
        return self

    def __contains__(self, name: str) -> bool:
        return name in self.definitions

    def names(self) -> list[str]:
        return list(self.definitions)

    # -- compiling -----------------------------------------------------------------------------
    def compile(self, expression: str, keep_unnamed=(), strip_quotes: bool = True) -> "Grok":
        if not expression:
            raise GrokError("a grok expression is required")
        keep_all = keep_unnamed is True
        keep = set() if keep_all else set(keep_unnamed or ())
        marks: list[tuple[str, str | None, str | None]] = []

        def expand(text: str, stack: tuple[str, ...]) -> str:
            out, pos = [], 0
            for m in _REF.finditer(text):
                out.append(text[pos:m.start()])
                pos = m.end()
                name, alias, typ = m.group("name"), m.group("alias"), m.group("type")
                if name not in self.definitions:
                    raise GrokError(f"grok pattern %{{{name}}} is not defined")
                if name in stack:
                    raise GrokError(f"grok pattern %{{{name}}} refers to itself: {' -> '.join(stack + (name,))}")
                body = expand(self.definitions[name], stack + (name,))
                if name in _GUARDS and self.definitions[name] == _bundled_definition(name):
                    body = _GUARDS[name] + "(?:" + body + ")"
                capture = alias or (name if (keep_all or name in keep) else None)
                if capture is None:
                    out.append(f"(?:{body})")
                else:
                    if typ is not None and typ.lower() not in _TYPES:
                        raise GrokError(f"unknown capture type '{typ}' in %{{{m.group(0)[2:-1]}}}")
                    marks.append((capture, _TYPES.get(typ.lower()) if typ else None,
                                  name if self.definitions[name] == _bundled_definition(name) else None))
                    out.append(f"{_MARK}{len(marks) - 1}>{body})")
            out.append(text[pos:])
            return "".join(out)

        expanded = expand(expression, ())
        regex, captures = _number_groups(expanded, marks)
        return Grok(expression=expression, regex=regex, captures=captures, strip_quotes=strip_quotes)


@dataclass
class Capture:
    name: str
    group: int          # 1-based group number in ``Grok.regex``
    cast: str | None    # Spark type for typed captures
    optional: bool      # group may not take part in a match
    may_quote: bool = True  # value may start with a quote (quote stripping applies)


@dataclass
class _Node:
    parent: "_Node | None"
    capture: int | None = None
    alt: bool = False
    zero: bool = False
    children: list = field(default_factory=list)


def _number_groups(rx: str, marks: list[tuple[str, str | None, str | None]]) -> tuple[str, list[Capture]]:
    """Turn capture marks and inline ``(?<name>`` groups into numbered groups, every other plain
    group into ``(?:``, and record whether each capture is optional."""
    out: list[str] = []
    root = _Node(None)
    stack = [root]
    caps: list[tuple[str, str | None, str | None, _Node]] = []
    i, n = 0, len(rx)
    while i < n:
        c = rx[i]
        if c == "\\":
            if rx.startswith("\\Q", i):
                j = rx.find("\\E", i + 2)
                j = n if j < 0 else j + 2
                out.append(rx[i:j])
                i = j
            else:
                out.append(rx[i:i + 2])
                i += 2
            continue
        if c == "[":
            j = _class_end(rx, i)
            out.append(rx[i:j])
            i = j
            continue
        if c == "(":
            node = _Node(stack[-1])
            stack[-1].children.append(node)
            stack.append(node)
            if rx.startswith(_MARK, i):
                j = rx.index(">", i)
                name, cast, source = marks[int(rx[i + len(_MARK):j])]
                caps.append((name, cast, source, node))
                node.capture = len(caps)
                out.append("(")
                i = j + 1
                continue
            m = _INLINE_NAME.match(rx, i)
            if m:
                caps.append((m.group(1), None, None, node))
                node.capture = len(caps)
                out.append("(")
                i = m.end()
                continue
            if rx.startswith("(?", i):
                out.append("(?")
                i += 2
                continue
            out.append("(?:")
            i += 1
            continue
        if c == ")":
            if len(stack) == 1:
                raise GrokError(f"unbalanced ')' in expanded expression: {rx[:200]}")
            node = stack.pop()
            rest = rx[i + 1:i + 12]
            if rest[:1] in ("?", "*") or _ZERO_MIN.match(rest):
                node.zero = True
            out.append(")")
            i += 1
            continue
        if c == "|":
            stack[-1].alt = True
        out.append(c)
        i += 1
    if len(stack) != 1:
        raise GrokError("unbalanced '(' in expanded expression")
    captures = []
    for k, (name, cast, source, node) in enumerate(caps, start=1):
        optional = node.zero
        p = node.parent
        while p is not None and not optional:
            optional = p.alt or p.zero
            p = p.parent
        captures.append(Capture(name=name, group=k, cast=cast, optional=optional,
                                may_quote=source not in NO_LEADING_QUOTE))
    return "".join(out), captures


_LITERAL_ESCAPES = set("[](){}.*+?^$|\\/-:@\"'#%&=,;!<> _~`")
_FLAG_GROUP = re.compile(r"\(\?([a-zA-Z-]+)[:)]")


def _group_spans(rx: str) -> list[tuple[int, int, bool]]:
    """(start, end, required) per group: required when the group has no alternation at its own
    level, is not followed by a quantifier allowing zero repetitions and is not a lookaround."""
    spans, stack, i, n = [], [], 0, len(rx)
    while i < n:
        c = rx[i]
        if c == "\\":
            if rx.startswith("\\Q", i):
                j = rx.find("\\E", i + 2)
                i = n if j < 0 else j + 2
            else:
                i += 2
            continue
        if c == "[":
            i = _class_end(rx, i)
            continue
        if c == "(":
            look = rx.startswith(("(?=", "(?!", "(?<=", "(?<!"), i)
            stack.append([i, look, False])
        elif c == ")" and stack:
            start, look, alt = stack.pop()
            rest = rx[i + 1:i + 12]
            zero = rest[:1] in ("?", "*") or bool(_ZERO_MIN.match(rest))
            spans.append((start, i, not (look or alt or zero)))
        elif c == "|" and stack:
            stack[-1][2] = True
        i += 1
    return spans


# A backslash and what belongs to it, longest forms first: properties, code points, control
# characters, references and names; then the one-letter classes, boundaries and characters.
_ESCAPE = re.compile(r"\\(?:[pP](?:\{[^}]*\}|.)|x(?:\{[0-9A-Fa-f]+\}|[0-9A-Fa-f]{2})|u[0-9A-Fa-f]{4}|0[0-7]{1,3}|k<[^>]*>|N\{[^}]*\}"
                     r"|[1-9][0-9]*|[dDwWsShHvVRXbBAZzGtrnfae])")


def required_literals(rx: str, limit: int = 3) -> list[str]:
    """Literal strings that every match of ``rx`` contains: runs of plain characters whose
    enclosing groups are all unconditional (see :func:`_group_spans`) and which carry no
    quantifier themselves.  Empty when unsure (top-level alternation, case-insensitive or comment
    mode, control-character or unknown escapes)."""
    if "\\c" in rx:  # the character after it may be any, also a bracket
        return []
    for m in _FLAG_GROUP.finditer(rx):
        if set(m.group(1).replace("-", "")) & set("ixuUc"):
            return []
    spans = _group_spans(rx)
    blocked = [False] * (len(rx) + 1)
    for start, end, ok in spans:
        if not ok:
            for k in range(start, end + 1):
                blocked[k] = True
    runs: list[str] = []
    cur: list[str] = []
    depth_alt_top = False
    i, n, depth = 0, len(rx), 0

    def close():
        if cur:
            runs.append("".join(cur))
            cur.clear()

    while i < n:
        c = rx[i]
        if c == "\\":
            if rx.startswith("\\Q", i):
                j = rx.find("\\E", i + 2)
                j = n if j < 0 else j
                lit, start, i = rx[i + 2:j], i, j + 2
                if not blocked[start] and not _quantified(rx, i):
                    cur.append(lit)
                else:
                    close()
                continue
            nxt, start = rx[i + 1:i + 2], i
            if nxt not in _LITERAL_ESCAPES:
                escape = _ESCAPE.match(rx, i)
                if not escape:
                    return []
                i = escape.end()  # not literal text: it ends the run, all of it
                close()
                continue
            i += 2
            if not blocked[start] and not _quantified(rx, i):
                cur.append(nxt)
            else:
                close()
            continue
        if c == "[":
            i = _class_end(rx, i)
            close()
            continue
        if c == "(":
            if rx.startswith("(?", i):
                # skip the group's own syntax: (?:  (?>  (?<name>  (?=  (?!  (?<=  (?<!  flags
                m = re.match(r"\(\?(?:<[a-zA-Z][a-zA-Z0-9]*>|<=|<!|[:>=!]|[a-zA-Z-]*[:)])", rx[i:])
                i += m.end() if m else 2
            else:
                i += 1
            depth += 1
            close()
            continue
        if c == ")":
            depth -= 1
            close()
            i += 1
            continue
        if c == "|":
            if depth == 0:
                depth_alt_top = True
            close()
            i += 1
            continue
        if c == "{":
            q = re.match(r"\{\d*(?:,\d*)?\}", rx[i:])
            if q:  # a counted quantifier, not text
                close()
                i += q.end()
                continue
        if not blocked[i] and c not in ".^$*+?{}" and not _quantified(rx, i + 1):
            cur.append(c)
        else:
            close()
        i += 1
    close()
    if depth_alt_top:
        return []
    runs = sorted({r for r in runs if r.strip()}, key=lambda r: (-len(r), r))
    return runs[:limit]


def _quantified(rx: str, i: int) -> bool:
    """Whether the atom ending just before ``i`` is followed by a quantifier."""
    return i < len(rx) and rx[i] in "?*+{"


def _class_end(rx: str, i: int) -> int:
    """Index just past the character class starting at ``rx[i] == '['`` (Java syntax: nested
    classes, escapes, a leading ']' is literal)."""
    j = i + 1
    if j < len(rx) and rx[j] == "^":
        j += 1
    if j < len(rx) and rx[j] == "]":
        j += 1
    depth = 1
    while j < len(rx):
        c = rx[j]
        if c == "\\":
            j += 2
            continue
        if c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if depth == 0:
                return j + 1
        j += 1
    raise GrokError(f"unterminated character class at {i}: {rx[i:i + 40]}")


@dataclass
class Grok:
    expression: str
    regex: str
    captures: list[Capture]
    strip_quotes: bool = True

    @property
    def fields(self) -> list[str]:
        seen: dict[str, None] = {}
        for c in self.captures:
            seen.setdefault(c.name, None)
        return list(seen)

    def onepass_regex(self) -> str:
        return f"(?s:^.*?)(?:{self.regex})(?s:.*)$"

    def onepass_template(self) -> str:
        body = "".join(f"{SEP}${c.group}" for c in self.captures)
        return HIT + (body or SEP)

    def parts(self, line: Column) -> Column:
        """``[HIT, g1, g2, ...]`` for a matching line; an array of one value, not ``HIT``, for another."""
        has_sep = F.instr(line, SEP) > 0
        one_pass = F.regexp_replace(line, F.lit(self.onepass_regex()), F.lit(self.onepass_template()))
        exact = [F.lit(HIT)] + ([F.regexp_extract(line, self.regex, c.group) for c in self.captures] or [F.lit("")])
        slow = F.when(line.rlike(self.regex), F.array(*exact)).otherwise(F.array(F.lit("")))
        # a line that does not match stays whole: [line], so every field reads NULL
        found = F.when(has_sep, slow).otherwise(F.split(one_pass, SEP, -1))
        possible = self.possible(line)
        return found if possible is None else F.when(possible, found).otherwise(F.array(line))

    def possible(self, line: Column) -> Column | None:
        """An exact shortcut: a line lacking a literal that every match contains cannot match, so the regex (an
        unanchored search, costly on long lines) need not run on it.  None where there is no such literal."""
        out = None
        for lit in required_literals(self.regex):
            has = F.instr(line, F.lit(lit)) > 0
            out = has if out is None else out & has
        return out

    def values(self, parts: Column) -> dict[str, Column]:
        """The fields, by name, from what :meth:`parts` gave."""

        def raw(c: Capture) -> Column:
            v = F.get(parts, c.group)
            return F.nullif(v, F.lit("")) if c.optional else v

        by_name: dict[str, list[Capture]] = {}
        for c in self.captures:
            by_name.setdefault(c.name, []).append(c)
        values = {}
        for name, group in by_name.items():
            if len(group) == 1:
                v = raw(group[0])
            else:
                cands = [F.nullif(raw(c), F.lit("")) for c in group]
                if not all(c.optional for c in group):
                    cands.append(F.lit(""))
                v = F.coalesce(*cands)
            cast = next((c.cast for c in group if c.cast), None)
            if cast:
                v = v.try_cast(cast)
            elif self.strip_quotes and any(c.may_quote for c in group):
                v = strip_quotes(v)
            values[name] = v
        return values

    def apply(self, df: DataFrame, source_col: str = "line", matched_col: str = "_matched",
              drop_helper: bool = True) -> DataFrame:
        """Add ``matched_col`` and one column per capture name.

        The one-pass form runs the regex once per line: ``regexp_replace`` rewrites a matching
        line to ``HIT SEP g1 SEP g2 ...`` and ``split`` yields all groups as one array.  Lines that
        contain the separator character build the same array exactly with ``rlike`` and one
        ``regexp_extract`` per group.  Field columns read the array, so each line is matched once
        and the generated code holds the slow path only once.
        """
        parts_name = "__grok_parts"
        parts_expr = self.parts(F.col(source_col))
        # One-row generator as an optimizer barrier: a later filter on a field (or on the
        # matched flag) is not inlined below it, so the regex still runs once per line, while
        # filters on the input columns keep reaching the scan.
        staged = materialize(df, parts_name, parts_expr)
        parts = F.col(parts_name)
        matched = (F.size(parts) >= 2) & (F.get(parts, 0) == F.lit(HIT))
        values = self.values(parts)
        out = staged.withColumn(matched_col, F.coalesce(matched, F.lit(False)))
        out = out.withColumns(values) if values else out
        return out.drop(parts_name) if drop_helper else out


def strip_quotes(v: Column) -> Column:
    """Remove one pair of surrounding double or single quotes (quoted-string captures)."""
    quoted = (F.length(v) >= 2) & (
        (v.startswith('"') & v.endswith('"')) | (v.startswith("'") & v.endswith("'")))
    return F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)


_DEFAULT: PatternLibrary | None = None
_BUNDLED: dict[str, str] | None = None


def _bundled_definition(name: str) -> str | None:
    global _BUNDLED
    if _BUNDLED is None:
        _BUNDLED = {}
        lib = PatternLibrary()
        for n in bundled_set_names() + ["grok-patterns"]:
            lib.add_file(os.path.join(_PATTERN_DIR, n))
        _BUNDLED = lib.definitions
    return _BUNDLED.get(name)


def default_library() -> PatternLibrary:
    global _DEFAULT
    if _DEFAULT is None:
        _DEFAULT = PatternLibrary.bundled()
    return _DEFAULT


def compile_grok(expression: str, library: PatternLibrary | None = None, keep_unnamed=(),
                 strip_quotes: bool = True) -> Grok:
    return (library or default_library()).compile(expression, keep_unnamed=keep_unnamed,
                                                  strip_quotes=strip_quotes)
