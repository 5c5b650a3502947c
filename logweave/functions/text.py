"""Column-level helpers that reproduce the reference's string rules with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java String.trim() removes every char <= U+0020 at both ends; F.trim alone strips spaces only.
_CTRL = "".join(chr(c) for c in range(0x21))
# Java's \s (no UNICODE_CHARACTER_CLASS): space, \t, \n, \x0B, \f, \r.
JAVA_WS = "[ \\t\\n\\x0B\\f\\r]"


def java_trim(c: Column) -> Column:
    return F.trim(c, F.lit(_CTRL))


def collapse_ws(c: Column) -> Column:
    """``\\s+`` → one space (applied before matching by the search-log job)."""
    return F.regexp_replace(c, JAVA_WS + "+", " ")


def file_line_id(file: Column, line_num: Column) -> Column:
    """The reference's id string ``<file>:<line>``."""
    return F.concat(file, F.lit(":"), line_num.cast("string"))
